"""Driver series: lag search, adequacy gate, imputation, assembly, as-of joins."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import round_to

from ..functions.aggregates import average_rank, safe_corr
from .calendar import future_grid

MIN_OBS = 5
MIN_COVERAGE_PCT = 70.0
IMPUTE_WINDOW = 3


def per_driver():
    return Window.partitionBy("series_id", "driver").orderBy("ds")


def lagged(drivers: DataFrame, low: int = 0, high: int = 3) -> DataFrame:
    """(series_id, driver, lag, ds, value): each driver value at the month it speaks for under each lag."""
    lags = drivers.select("series_id", "driver", F.col("ds").alias("source"), "raw", F.explode(F.sequence(F.lit(low), F.lit(high))).alias("lag"))
    return lags.select("series_id", "driver", "lag", F.add_months("source", F.col("lag")).alias("ds"), F.col("raw").alias("value"))


def lag_search(prices: DataFrame, drivers: DataFrame, low: int = 0, high: int = 3, min_obs: int = MIN_OBS, pearson_weight: float = 1.0, spearman_weight: float = 0.0) -> DataFrame:
    """One row a series, driver and lag: n_obs, pearson, spearman, ensemble (null
    where either correlation is), selected (the highest ensemble, ties to the
    smaller lag). Lags with fewer than min_obs pairs have no scores."""
    pairs = lagged(drivers.where("raw is not null"), low, high).join(prices.where("price is not null").select("series_id", "ds", "price"), ["series_id", "ds"])
    key = ["series_id", "driver", "lag"]
    ranked = average_rank(average_rank(pairs, key, "price", "price_rank"), key, "value", "value_rank")
    enough = lambda c: F.when(F.count("*") >= min_obs, c)
    scored = ranked.groupBy(*key).agg(F.count("*").alias("n_obs"), enough(safe_corr("price", "value")).alias("pearson"), enough(safe_corr("price_rank", "value_rank")).alias("spearman"))
    scored = scored.withColumn("ensemble", F.abs("pearson") * pearson_weight + F.abs("spearman") * spearman_weight)
    best = F.row_number().over(Window.partitionBy("series_id", "driver").orderBy(F.desc_nulls_last(round_to("ensemble", 9)), "lag"))
    return scored.withColumn("selected", (best == 1) & F.col("ensemble").isNotNull())


def selected_lags(drivers: DataFrame, scores: DataFrame) -> DataFrame:
    """(series_id, driver, ds, lag, raw, lagged) of drivers with a selected lag, on every
    month that either the raw or the lagged column has."""
    chosen = scores.where("selected").select("series_id", "driver", "lag")
    kept = drivers.join(chosen, ["series_id", "driver"])
    moved = kept.select("series_id", "driver", "lag", F.add_months("ds", F.col("lag")).alias("ds"), F.col("raw").alias("lagged"), F.lit(None).cast("double").alias("raw"))
    both = moved.unionByName(kept.select("series_id", "driver", "lag", "ds", F.lit(None).cast("double").alias("lagged"), "raw"))
    return both.groupBy("series_id", "driver", "lag", "ds").agg(F.max("raw").alias("raw"), F.max("lagged").alias("lagged"))


def on_price_dates(prices: DataFrame, chosen: DataFrame) -> DataFrame:
    """The lagged column of every chosen driver on each date of its series' prices."""
    names = chosen.select("series_id", "driver").distinct()
    grid = prices.select("series_id", "ds").join(names, "series_id")
    return grid.join(chosen.select("series_id", "driver", "ds", "lagged"), ["series_id", "driver", "ds"], "left")


def adequacy_gate(prices: DataFrame, chosen: DataFrame, min_coverage_pct: float = MIN_COVERAGE_PCT) -> DataFrame:
    """(series_id, driver, n_rows, n_present, coverage_pct, action): excluded below the
    least coverage, imputed below 100 %, else included. Coverage is that of the
    lagged column, so a longer lag lowers it."""
    counted = on_price_dates(prices, chosen).groupBy("series_id", "driver").agg(F.count("*").alias("n_rows"), F.count("lagged").alias("n_present"))
    pct = F.when(F.col("n_rows") > 0, 100.0 * F.col("n_present") / F.col("n_rows")).otherwise(0.0)
    action = F.when(pct < min_coverage_pct, "excluded").when(pct < 100, "imputed").otherwise("included")
    return counted.withColumn("coverage_pct", pct).withColumn("action", action)


def impute_moving_average(rows: DataFrame, value: str = "lagged", window: int = IMPUTE_WINDOW) -> DataFrame:
    """Nulls become the mean of the trailing window, if it has any value; longer gaps stay."""
    mean = F.avg(value).over(per_driver().rowsBetween(-(window - 1), 0))
    return rows.withColumn(value, F.coalesce(F.col(value), mean))


def impute_linear(rows: DataFrame, value: str = "lagged") -> DataFrame:
    """Nulls between two values lie on the line through them; after the last value
    it is repeated; before the first they stay null."""
    before, after = per_driver().rowsBetween(Window.unboundedPreceding, 0), per_driver().rowsBetween(0, Window.unboundedFollowing)
    place = F.row_number().over(per_driver())
    rows = rows.withColumn("_at", place).withColumn("_known", F.when(F.col(value).isNotNull(), F.struct("_at", F.col(value).alias("v"))))
    rows = rows.withColumn("_low", F.last("_known", True).over(before)).withColumn("_high", F.first("_known", True).over(after))
    share = (F.col("_at") - F.col("_low._at")) / F.nullif(F.col("_high._at") - F.col("_low._at"), F.lit(0))
    line = F.col("_low.v") + share * (F.col("_high.v") - F.col("_low.v"))
    filled = F.when(F.col("_low").isNotNull(), F.coalesce(F.col(value), line, F.col("_low.v")))
    return rows.withColumn(value, filled).drop("_at", "_known", "_low", "_high")


def impute_spline(rows: DataFrame, value: str = "lagged", order: int = 3) -> DataFrame:
    """Nulls between values by a natural cubic spline through them, linear where
    there are too few; after the last value it is repeated."""

    def fill(part: pd.DataFrame) -> pd.DataFrame:
        from ..functions.kernels import natural_spline

        part = part.sort_values("ds", kind="stable")
        part[value] = natural_spline(part[value].to_numpy(float), order)
        return part

    return rows.groupBy("series_id", "driver").applyInPandas(fill, rows.schema)


IMPUTERS = {"moving_average": impute_moving_average, "linear": impute_linear, "spline": impute_spline}


def gated_drivers(prices: DataFrame, chosen: DataFrame, method: str = "moving_average", min_coverage_pct: float = MIN_COVERAGE_PCT) -> DataFrame:
    """(series_id, driver, ds, value): lagged values on price dates, imputed where the gate says so."""
    if method not in IMPUTERS:
        raise ValueError(f"imputation is one of {sorted(IMPUTERS)}, not {method!r}")
    gate = adequacy_gate(prices, chosen, min_coverage_pct).where("action <> 'excluded'").select("series_id", "driver", "action")
    rows = on_price_dates(prices, chosen).join(gate, ["series_id", "driver"])
    whole = rows.where("action = 'included'")
    filled = IMPUTERS[method](rows.where("action = 'imputed'"))
    return whole.unionByName(filled).select("series_id", "driver", "ds", F.col("lagged").alias("value"))


def assemble(features: DataFrame, gated: DataFrame) -> DataFrame:
    """Features beside a map of driver values; rows that miss any driver of their
    series go. Series without drivers keep all their rows."""
    n = gated.groupBy("series_id").agg(F.count_distinct("driver").alias("n_drivers"))
    maps = gated.where("value is not null").groupBy("series_id", "ds").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("driver", "value")))).alias("drivers"))
    joined = features.join(maps, ["series_id", "ds"], "left").join(n, "series_id", "left")
    return joined.where(F.coalesce(F.size("drivers"), F.lit(0)) >= F.coalesce("n_drivers", F.lit(0))).drop("n_drivers")


def last_known(drivers: DataFrame, windows: DataFrame) -> DataFrame:
    """(series_id, driver, window_no, value, known_at): the last value at or before each window's end."""
    joined = drivers.where("raw is not null").join(windows.select("series_id", "window_no", "train_end"), "series_id").where("ds <= train_end")
    return joined.groupBy("series_id", "driver", "window_no").agg(F.max_by("raw", "ds").alias("value"), F.max("ds").alias("known_at"))


def project_flat(drivers: DataFrame, windows: DataFrame, periods: int) -> DataFrame:
    """(series_id, driver, window_no, ds, projected): the last known value carried forward."""
    known = last_known(drivers, windows).join(windows.select("series_id", "window_no", "train_end"), ["series_id", "window_no"])
    return known.select("series_id", "driver", "window_no", F.explode(F.sequence(F.lit(1), F.lit(periods))).alias("step"), "known_at", "value").select(
        "series_id", "driver", "window_no", F.add_months("known_at", F.col("step")).alias("ds"), F.col("value").alias("projected")
    )


def lagged_future(drivers: DataFrame, chosen_lags: DataFrame, projected: DataFrame, windows: DataFrame, steps: int) -> DataFrame:
    """(series_id, driver, window_no, step, ds, source, value, origin): what a lagged
    driver says about each forecast month, as known at the window's end: the real
    value if its source month is not later, else the projection, else null."""
    future = windows.select("series_id", "window_no", "train_end", F.explode(F.sequence(F.lit(1), F.lit(steps))).alias("step"))
    future = future.withColumn("ds", F.add_months("train_end", F.col("step"))).join(chosen_lags.select("series_id", "driver", "lag"), "series_id")
    future = future.withColumn("source", F.add_months("ds", -F.col("lag")))
    real = drivers.select("series_id", "driver", F.col("ds").alias("source"), F.col("raw").alias("real"))
    told = projected.select("series_id", "driver", "window_no", F.col("ds").alias("source"), "projected")
    joined = future.join(real, ["series_id", "driver", "source"], "left").join(told, ["series_id", "driver", "window_no", "source"], "left")
    allowed = F.when(F.col("source") <= F.col("train_end"), F.col("real"))
    origin = F.when(allowed.isNotNull(), "real").when(F.col("projected").isNotNull(), "projected").otherwise("none")
    return joined.select("series_id", "driver", "window_no", "step", "ds", "source", F.coalesce(allowed, "projected").alias("value"), origin.alias("origin"))


def future_dates(prices: DataFrame, periods: int) -> DataFrame:
    return future_grid(prices, periods)
