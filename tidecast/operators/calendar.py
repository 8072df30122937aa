"""Calendar grids: dense months, forecast dates, backtest windows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import PERIODS_PER_YEAR, shift_periods

def per_series():
    """The rows of a series in order of time."""
    return Window.partitionBy("series_id").orderBy("ds")


def dense_grid(prices: DataFrame, frequency: str = "monthly") -> DataFrame:
    """(series_id, ds, price) with a row for every period between a series' first
    and last, null where there was none. Lags are row shifts, so they need this."""
    step = F.expr(f"interval {12 // PERIODS_PER_YEAR[frequency]} month")
    bounds = prices.groupBy("series_id").agg(F.min("ds").alias("a"), F.max("ds").alias("b"))
    days = bounds.select("series_id", F.explode(F.sequence("a", "b", step)).alias("ds"))
    return days.join(prices.select("series_id", "ds", "price"), ["series_id", "ds"], "left")


def missing_periods(prices: DataFrame, frequency: str = "monthly") -> DataFrame:
    """(series_id, ds) of the grid that prices lack."""
    return dense_grid(prices, frequency).select("series_id", "ds").join(prices.select("series_id", "ds"), ["series_id", "ds"], "left_anti")


def future_grid(prices: DataFrame, periods: int, frequency: str = "monthly") -> DataFrame:
    """(series_id, step, ds): the next periods after each series' last."""
    last = prices.groupBy("series_id").agg(F.max("ds").alias("last"))
    steps = last.select("series_id", "last", F.explode(F.sequence(F.lit(1), F.lit(periods))).alias("step"))
    return steps.select("series_id", "step", shift_periods("last", F.col("step"), frequency).alias("ds"))


def backtest_windows(prices: DataFrame, anchor: str, frequency: str = "monthly", n_windows: int | None = None) -> DataFrame:
    """(series_id, window_no, train_end, n_train): one window for each price on or
    after the anchor (or the last n_windows), each ending one period later."""
    rows = prices.where("price is not null")
    n = F.lit(n_windows) if n_windows else F.count_if(F.col("ds") >= F.lit(anchor).cast("date")).cast("int")
    last = rows.groupBy("series_id").agg(F.max("ds").alias("last"), n.alias("n")).where("n > 0")
    ends = last.select("series_id", "last", "n", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("window_no"))
    ends = ends.select("series_id", "window_no", shift_periods("last", F.col("window_no") - F.col("n"), frequency).alias("train_end"))
    ranks = rows.select("series_id", "ds", F.row_number().over(per_series()).alias("n_train"))
    found = ends.join(ranks, (ends.series_id == ranks.series_id) & (ranks.ds <= ends.train_end), "left")
    return found.groupBy(ends.series_id, "window_no", "train_end").agg(F.coalesce(F.max("n_train"), F.lit(0)).alias("n_train"))


def infer_frequency(dates: DataFrame) -> DataFrame:
    """(series_id, start, median_gap, frequency): monthly up to a median gap of 45
    days, quarterly up to 120, else unknown."""
    gaps = dates.select("series_id", "ds").distinct().withColumn("gap", F.datediff("ds", F.lag("ds").over(per_series())))
    out = gaps.groupBy("series_id").agg(F.min("ds").alias("start"), F.percentile("gap", 0.5).alias("median_gap"))
    kind = F.when(F.col("median_gap") <= 45, "monthly").when(F.col("median_gap") <= 120, "quarterly").otherwise("unknown")
    return out.withColumn("frequency", kind)
