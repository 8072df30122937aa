"""Engineered features of a price series as window expressions.

Every frame ends one row before the current one: no feature but the named leak
reads the price it helps to predict. Prices must be on a dense grid.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import PERIODS_PER_YEAR, cyclic, safe_div, scale_periods
from .calendar import per_series

# Sizes in months, and the least number of periods of a rolling window.
LAGS = (1, 2, 3, 6, 12)
ROLLING = (3, 6, 12)
CUMULATIVE = (3, 6)
LONG, LONG_LEAST = 36, 12


def sizes(frequency: str = "monthly") -> dict:
    """Sizes in periods; those that fall together are kept once."""
    one = lambda months, least=1: list(dict.fromkeys(scale_periods(m, frequency, least) for m in months))
    return {"lags": one(LAGS), "rolling": one(ROLLING, 2), "cumulative": one(CUMULATIVE), "long": scale_periods(LONG, frequency), "long_least": scale_periods(LONG_LEAST, frequency)}


def feature_table(frequency: str = "monthly") -> list[tuple[str, str, int | None]]:
    """(feature, family, safety horizon): a feature may serve step h if h is at most
    its horizon; None is safe at any step."""
    s = sizes(frequency)
    out: list[tuple[str, str, int | None]] = [(f"lag_{k}", "lag", k) for k in s["lags"]]
    out += [(f"roll_{f}_{k}", "rolling", k) for k in s["rolling"] for f in ("mean", "std", "min", "max")]
    out += [(f"{f}_{k}", "rolling", k) for f in ("roll_zscore", "coef_var") for k in s["rolling"]]
    out += [(n, "change", 1) for n in ("mom_change", "mom_pct_change", "mom_pct_lag1", "mom_pct_lag2")]
    out += [(f"cum_return_{k}p", "change", k) for k in s["cumulative"]]
    out += [("price_to_ma_long", "ratio", s["rolling"][-1]), ("price_to_ma_short", "ratio", s["rolling"][0]), ("ma_short_to_ma_long", "ratio", s["rolling"][-1])]
    out += [(n, "calendar", None) for n in ("month", "quarter", "year", "month_sin", "month_cos", "quarter_sin", "quarter_cos", "years_since_start")]
    out += [(f"is_q{q}", "calendar", None) for q in range(1, 5)]
    if frequency == "monthly":
        out += [(f"is_{m}", "calendar", None) for m in MONTHS]
    out += [(n, "expanding", None) for n in ("expanding_mean", "expanding_std", "price_to_expanding_mean", "seasonal_index")]
    k = s["long"]
    return out + [(f"rolling_mean_{k}", "rolling", k), (f"rolling_std_{k}", "rolling", k), (f"price_to_rolling_mean_{k}", "rolling", k)]


MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")


def _over(fn, frame, needed: int) -> Column:
    return F.when(F.count("price").over(frame) >= needed, fn("price").over(frame))


def engineer(prices: DataFrame, frequency: str = "monthly", leak: bool = True) -> DataFrame:
    """series_id, ds, price and all features, rows with gaps included. With leak,
    price_to_rolling_mean reads the current price, else the one before."""
    s, back = sizes(frequency), lambda k: F.lag("price", k).over(per_series())
    one = back(1)
    c: dict[str, Column] = {f"lag_{k}": back(k) for k in s["lags"]}
    for k in s["rolling"]:
        frame = per_series().rowsBetween(-k, -1)
        for name, fn in (("mean", F.avg), ("std", F.stddev_samp), ("min", F.min), ("max", F.max)):
            c[f"roll_{name}_{k}"] = _over(fn, frame, k)
    for k in s["rolling"]:
        mean, std = c[f"roll_mean_{k}"], c[f"roll_std_{k}"]
        c[f"roll_zscore_{k}"] = F.coalesce((one - mean) / F.when(std > 0, std), F.lit(0.0))
        c[f"coef_var_{k}"] = safe_div(std, mean)
    ratio = lambda a, b: (safe_div(a, b) - 1) * 100
    c |= {"mom_change": one - back(2), "mom_pct_change": ratio(one, back(2)), "mom_pct_lag1": ratio(back(2), back(3)), "mom_pct_lag2": ratio(back(3), back(4))}
    c |= {f"cum_return_{k}p": ratio(one, back(1 + k)) for k in s["cumulative"]}
    short, long = c[f"roll_mean_{s['rolling'][0]}"], c[f"roll_mean_{s['rolling'][-1]}"]
    c |= {"price_to_ma_long": safe_div(one, long), "price_to_ma_short": safe_div(one, short), "ma_short_to_ma_long": safe_div(short, long)}
    month, quarter, year = F.month("ds"), F.quarter("ds"), F.year("ds")
    c |= {"month": month, "quarter": quarter, "year": year}
    c["month_sin"], c["month_cos"] = cyclic(month, 12)
    c["quarter_sin"], c["quarter_cos"] = cyclic(quarter, 4)
    c["years_since_start"] = year - F.min(year).over(Window.partitionBy("series_id"))
    c |= {f"is_q{q}": (quarter == q).cast("int") for q in range(1, 5)}
    if frequency == "monthly":
        c |= {f"is_{m}": (month == i).cast("int") for i, m in enumerate(MONTHS, 1)}
    before = per_series().rowsBetween(Window.unboundedPreceding, -1)
    mean = F.avg("price").over(before)
    c |= {"expanding_mean": mean, "expanding_std": F.stddev_samp("price").over(before), "price_to_expanding_mean": safe_div(one, mean)}
    season = month if PERIODS_PER_YEAR[frequency] == 12 else quarter
    same = Window.partitionBy("series_id", season).orderBy("ds").rowsBetween(Window.unboundedPreceding, -1)
    c["seasonal_index"] = safe_div(F.avg("price").over(same), mean)
    k, frame = s["long"], per_series().rowsBetween(-s["long"], -1)
    c[f"rolling_mean_{k}"], c[f"rolling_std_{k}"] = _over(F.avg, frame, s["long_least"]), _over(F.stddev_samp, frame, s["long_least"])
    c[f"price_to_rolling_mean_{k}"] = safe_div(F.col("price") if leak else one, c[f"rolling_mean_{k}"])
    names = [n for n, _, _ in feature_table(frequency)]
    return prices.select("series_id", "ds", "price", *(c[n].alias(n) for n in names))


def complete_cases(features: DataFrame) -> DataFrame:
    """Rows without a null: warm-up rows go."""
    return features.na.drop()


def safe_features(step: int, frequency: str = "monthly") -> list[str]:
    """The features that a direct model of step h may use."""
    return [n for n, _, horizon in feature_table(frequency) if horizon is None or step <= horizon]


def direct_target(features: DataFrame, step: int) -> DataFrame:
    """Adds target: the price `step` rows later (row based, after complete cases)."""
    return features.withColumn("target", F.lead("price", step).over(per_series()))


def window_features(prices: DataFrame) -> DataFrame:
    """(series_id, ds, price, month_sin, month_cos, year): the inputs of models that read
    whole windows, the cyclic ones to six places."""
    month_sin, month_cos = cyclic(F.month("ds"), 12)
    return prices.select("series_id", "ds", "price", F.round(month_sin, 6).alias("month_sin"), F.round(month_cos, 6).alias("month_cos"), F.year("ds").alias("year"))


def min_max(rows: DataFrame, columns: list[str], train_end: str | None = None, key: str = "series_id") -> DataFrame:
    """Adds <column>_scaled, between 0 and 1 over the rows up to train_end (all, without it), and
    <column>_low and <column>_range to undo it; columns that do not vary become 0."""
    known = F.lit(True) if train_end is None else F.col("ds") <= F.lit(train_end).cast("date")
    out = rows
    for c in columns:
        low, high = (fn(F.when(known, F.col(c))).over(Window.partitionBy(key)) for fn in (F.min, F.max))
        out = out.withColumns({f"{c}_low": low, f"{c}_range": high - low})
        out = out.withColumn(f"{c}_scaled", F.when(F.col(f"{c}_range") == 0, 0.0).otherwise((F.col(c) - F.col(f"{c}_low")) / F.col(f"{c}_range")))
    return out


def min_max_inverse(scaled: Column, low: Column, span: Column) -> Column:
    return scaled * span + low
