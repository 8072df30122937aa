"""Data-quality flags and descriptive tables of price series."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import round_to

from ..functions.aggregates import kurtosis_excess, skewness_pop
from .calendar import per_series, missing_periods

MAX_LISTED = 10
FLAT_RUN = 4


def _flag(df: DataFrame, check: str, severity: str, detail) -> DataFrame:
    return df.select("series_id", F.lit(check).alias("check"), F.lit(severity).alias("severity"), detail.alias("detail"))


def _month(c: str):
    return F.date_format(c, "yyyy-MM")


def quality_flags(prices: DataFrame, frequency: str = "monthly") -> DataFrame:
    """(series_id, check, severity, detail) of six checks; prices may have nulls,
    gaps and repeated dates."""
    rows, clean = prices.select("series_id", "ds", "price"), prices.where("price is not null").select("series_id", "ds", "price")
    per = rows.groupBy("series_id").agg(F.count("*").alias("n"), F.count_if(F.col("price").isNull()).alias("missing"), (F.count("*") - F.count_distinct("ds")).alias("repeats"), F.count_if(F.col("price") < 0).alias("negative"))
    out = [
        _flag(per.where("missing > 0"), "missing_or_non_numeric_price", "warning", F.format_string("%d of %d price values are missing or non-numeric", "missing", "n")),
        _flag(per.where("repeats > 0"), "duplicate_dates", "error", F.format_string("%d duplicate date(s) in the price index", "repeats")),
        _flag(per.where("negative > 0"), "negative_price", "warning", F.format_string("%d negative price value(s)", "negative")),
    ]
    place = F.row_number().over(per_series())
    gaps = missing_periods(rows.groupBy("series_id", "ds").agg(F.first("price").alias("price")), frequency).withColumn("at", place)
    gaps = gaps.groupBy("series_id").agg(F.count("*").alias("n"), F.sort_array(F.collect_list(F.when(F.col("at") <= MAX_LISTED, F.struct("at", _month("ds").alias("m"))))).alias("some"))
    listed = F.array_join(F.transform("some", lambda x: x["m"]), ", ")
    out.append(_flag(gaps, "missing_calendar_periods", "error", F.concat(F.format_string("%d missing periods: ", "n"), listed, F.when(F.col("n") > MAX_LISTED, " ...").otherwise(""))))
    whole = Window.partitionBy("series_id")
    z = clean.withColumn("sd", F.stddev_samp("price").over(whole)).withColumn("z", F.when(F.col("sd") > 0, (F.col("price") - F.avg("price").over(whole)) / F.col("sd")))
    far = z.where("abs(z) > 3").groupBy("series_id").agg(F.count("*").alias("n"), F.sort_array(F.collect_list(F.struct("ds", "price"))).alias("rows"))
    told = F.array_join(F.transform("rows", lambda x: F.concat(F.date_format(x["ds"], "yyyy-MM"), F.lit("="), F.format_string("%.2f", x["price"]))), ", ")
    out.append(_flag(far, "price_outliers", "warning", F.concat(F.format_string("%d value(s) with |z-score| > 3: ", "n"), told)))
    runs = flat_runs(clean).where(F.col("length") >= FLAT_RUN)
    first = runs.groupBy("series_id").agg(F.max_by(F.struct("length", "end"), F.struct("length", (-F.unix_date("end")).alias("early"))).alias("r"))
    out.append(_flag(first, "flat_stretch", "info", F.concat(F.format_string("%d consecutive identical price values ending ", "r.length"), _month("r.end"))))
    union = out[0]
    for df in out[1:]:
        union = union.unionByName(df)
    return union


def flat_runs(clean: DataFrame) -> DataFrame:
    """(series_id, run, price, length, end): stretches of equal consecutive prices."""
    changed = F.coalesce((F.col("price") != F.lag("price").over(per_series())).cast("int"), F.lit(1))
    runs = clean.withColumn("changed", changed).withColumn("run", F.sum("changed").over(per_series()))
    return runs.groupBy("series_id", "run").agg(F.min("price").alias("price"), F.count("*").alias("length"), F.max("ds").alias("end"))


def summary_statistics(prices: DataFrame) -> DataFrame:
    """Count, mean, spread, range, population skewness, excess kurtosis and percentiles."""
    pct = {f"p{q}": F.percentile("price", q / 100) for q in (10, 25, 50, 75, 90)}
    return prices.where("price is not null").groupBy("series_id").agg(
        F.count("price").alias("n"), F.avg("price").alias("mean"), F.stddev_samp("price").alias("std"), F.min("price").alias("min"), F.max("price").alias("max"),
        skewness_pop("price").alias("skew"), kurtosis_excess("price").alias("kurtosis"), *(c.alias(n) for n, c in pct.items()),
    )


def trend(prices: DataFrame, window: int = 12) -> DataFrame:
    """Price with the mean and spread of the window that ends with it."""
    frame = per_series().rowsBetween(-(window - 1), 0)
    full = F.count("price").over(frame) >= window
    return prices.select("series_id", "ds", "price", F.when(full, F.avg("price").over(frame)).alias("rolling_mean"), F.when(full, F.stddev_samp("price").over(frame)).alias("rolling_std"))


def returns(prices: DataFrame, window: int = 6) -> DataFrame:
    """Percentage returns, first differences and rolling volatility."""
    last, frame = F.lag("price").over(per_series()), per_series().rowsBetween(-(window - 1), 0)
    rows = prices.select("series_id", "ds", "price", F.when(last != 0, (F.col("price") / last - 1) * 100).alias("ret"), (F.col("price") - last).alias("diff"))
    return rows.withColumn("volatility", F.when(F.count("ret").over(frame) >= window, F.stddev_samp("ret").over(frame)))


def return_statistics(prices: DataFrame) -> DataFrame:
    """Mean and spread of returns, and the dates of the largest rise and fall."""
    rows = returns(prices).where("ret is not null")
    return rows.groupBy("series_id").agg(
        F.avg("ret").alias("mean_ret"), F.stddev_samp("ret").alias("std_ret"), F.max("ret").alias("max_ret"), F.min("ret").alias("min_ret"),
        F.max_by("ds", F.struct(round_to("ret", 9), F.unix_date("ds"))).alias("max_ds"), F.min_by("ds", F.struct(round_to("ret", 9), F.unix_date("ds"))).alias("min_ds"),
    )


def month_year_means(prices: DataFrame) -> DataFrame:
    """One row a series and year, a column for each month's mean price."""
    months = [F.avg(F.when(F.month("ds") == m, F.col("price"))).alias(f"m{m}") for m in range(1, 13)]
    return prices.groupBy("series_id", F.year("ds").alias("year")).agg(*months)


def month_boxes(prices: DataFrame) -> DataFrame:
    """Five-number summary of the prices of each calendar month."""
    q = lambda p: F.percentile("price", p)
    return prices.where("price is not null").groupBy("series_id", F.month("ds").alias("month")).agg(F.min("price").alias("low"), q(0.25).alias("q1"), q(0.5).alias("median"), q(0.75).alias("q3"), F.max("price").alias("high"), F.count("*").alias("n"))


def histogram(prices: DataFrame, bins: int = 20) -> DataFrame:
    """(series_id, bin, from_price, to_price, n, normal): equal-width bins with the count a
    normal curve of the same mean and spread would give by its density at the middle."""
    stats = prices.where("price is not null").groupBy("series_id").agg(F.min("price").alias("a"), F.max("price").alias("b"), F.avg("price").alias("mean"), F.stddev_samp("price").alias("sd"), F.count("*").alias("total")).where("b > a")
    rows = prices.where("price is not null").join(stats, "series_id")
    at = F.least(F.lit(bins - 1), F.floor((F.col("price") - F.col("a")) / (F.col("b") - F.col("a")) * bins)).cast("int")
    counts = rows.groupBy("series_id", at.alias("bin")).agg(F.count("*").alias("n"))
    grid = stats.select("*", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin")).join(counts, ["series_id", "bin"], "left")
    width = (F.col("b") - F.col("a")) / bins
    low = F.col("a") + F.col("bin") * width
    z = (low + width / 2 - F.col("mean")) / F.col("sd")
    normal = F.col("total") * width / F.col("sd") * F.exp(-z * z / 2) / F.sqrt(F.lit(2.0) * F.pi())
    return grid.select("series_id", "bin", low.alias("from_price"), (low + width).alias("to_price"), F.coalesce("n", F.lit(0)).alias("n"), normal.alias("normal"))


def autocorrelation(prices: DataFrame, lags: int = 12, value: str = "price") -> DataFrame:
    """(series_id, lag, acf) with the usual full-sample mean and variance."""
    whole = Window.partitionBy("series_id")
    rows = prices.where(F.col(value).isNotNull()).withColumn("x", F.col(value) - F.avg(value).over(whole)).withColumn("at", F.row_number().over(per_series()))
    left = rows.select("series_id", "at", "x", F.explode(F.sequence(F.lit(0), F.lit(lags))).alias("lag"))
    right = rows.select("series_id", F.col("at").alias("other"), F.col("x").alias("y"))
    joined = left.join(right, (left.series_id == right.series_id) & (F.col("other") == F.col("at") - F.col("lag"))).groupBy(left.series_id, "lag").agg(F.sum(F.col("x") * F.col("y")).alias("c"))
    total = F.max(F.when(F.col("lag") == 0, F.col("c"))).over(whole)
    return joined.select("series_id", "lag", F.when(total > 0, F.col("c") / total).alias("acf"))


def density(prices: DataFrame, points: int = 100) -> DataFrame:
    """(series_id, point, at, density): a Gaussian kernel estimate with Scott's bandwidth, at
    evenly spaced places from the least to the largest price. Series whose prices do
    not vary have none. The places are a fixed number, so each row meets that many."""
    rows = prices.where("price is not null").select("series_id", "price")
    range_of = rows.groupBy("series_id").agg(F.min("price").alias("low"), F.max("price").alias("high"), F.count("*").alias("n"), F.stddev_samp("price").alias("spread")).where("spread > 0")
    places = range_of.select("*", (F.col("spread") * F.pow("n", F.lit(-0.2))).alias("width"), F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("point"))
    places = places.withColumn("at", F.col("low") + (F.col("high") - F.col("low")) * F.col("point") / (points - 1))
    z = (F.col("at") - F.col("price")) / F.col("width")
    total = F.sum(F.exp(-z * z / 2)) / (F.first("n") * F.first("width") * F.sqrt(F.lit(2 * 3.141592653589793)))
    return rows.join(places, "series_id").groupBy("series_id", "point", "at").agg(total.alias("density"))
