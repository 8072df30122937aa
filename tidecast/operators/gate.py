"""Robustness gate: ablation against a sibling without drivers, then a permutation test."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.config import GATE_SIBLINGS, Gate


def ablation(summary: DataFrame, cfg: Gate = Gate()) -> DataFrame:
    """(series_id, technique, sibling, mape, sibling_mape, mape_drop, ablation_passed) over
    long-horizon windows that have actuals."""
    rows = summary.where("horizon = 'long' and months_evaluated > 0")
    mean = rows.groupBy("series_id", "technique").agg(F.avg("mape").alias("mape"))
    pairs = mean.sparkSession.createDataFrame(list(GATE_SIBLINGS.items()), "technique string, sibling string")
    own = mean.join(F.broadcast(pairs), "technique")
    other = mean.select("series_id", F.col("technique").alias("sibling"), F.col("mape").alias("sibling_mape"))
    joined = own.join(other, ["series_id", "sibling"], "left").withColumn("mape_drop", F.col("sibling_mape") - F.col("mape"))
    return joined.withColumn("ablation_passed", F.coalesce(F.col("mape_drop") > cfg.min_mape_drop, F.lit(False)))


def permutation(real: DataFrame, shuffled: DataFrame, cfg: Gate = Gate()) -> DataFrame:
    """(series_id, technique, real_mape, n_permutations, p_value, permutation_passed). shuffled:
    series_id, technique, seed, mape; a shuffle that ties or beats the real error counts against it."""
    joined = real.select("series_id", "technique", F.col("mape").alias("real_mape")).join(shuffled.where("mape is not null"), ["series_id", "technique"])
    out = joined.groupBy("series_id", "technique", "real_mape").agg(F.count("*").alias("n_permutations"), ((F.count_if(F.col("mape") <= F.col("real_mape")) + 1) / (F.count("*") + 1)).alias("p_value"))
    return out.withColumn("permutation_passed", F.col("p_value") < cfg.max_p_value)


def combined(ablated: DataFrame, permuted: DataFrame) -> DataFrame:
    """(series_id, technique, ..., passed): both tests must pass."""
    out = ablated.join(permuted.select("series_id", "technique", "p_value", "permutation_passed"), ["series_id", "technique"], "left")
    return out.withColumn("passed", F.col("ablation_passed") & F.coalesce("permutation_passed", F.lit(False)))


def shuffle_columns(drivers: DataFrame, seed: int) -> DataFrame:
    """Driver values dealt anew over each driver's own dates, by a hash of date and seed."""
    from pyspark.sql import Window

    key = ["series_id", "driver"]
    mixed = F.xxhash64("series_id", "driver", "ds", F.lit(seed))
    rows = drivers.withColumn("_to", F.row_number().over(Window.partitionBy(*key).orderBy("ds"))).withColumn("_from", F.row_number().over(Window.partitionBy(*key).orderBy(mixed, "ds")))
    given = rows.select(*key, F.col("_from").alias("_to"), "raw")
    return rows.select(*key, "ds", "_to").join(given, [*key, "_to"]).drop("_to")
