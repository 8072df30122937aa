"""Driver and feature selection: thresholds, redundancy, overrides, unions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.aggregates import safe_corr
from ..functions.scalars import is_exchange_rate, round_to

MIN_ABS_CORR = 0.4
MAX_PAIR_CORR = 0.7
RELATIVE = 1.2


def pair_correlations(rows: DataFrame, name: str, value: str) -> DataFrame:
    """(series_id, a, b, corr) for each two names a < b of a series, over shared dates."""
    left = rows.select("series_id", "ds", F.col(name).alias("a"), F.col(value).alias("_x"))
    right = rows.select("series_id", "ds", F.col(name).alias("b"), F.col(value).alias("_y"))
    return left.join(right, ["series_id", "ds"]).where("a < b").groupBy("series_id", "a", "b").agg(safe_corr("_x", "_y").alias("corr"))


def greedy_redundancy(ranked: DataFrame, pairs: DataFrame, limit: float = MAX_PAIR_CORR) -> DataFrame:
    """(series_id, name, strength, place, kept): names by falling strength (ties by
    name); one is dropped if it correlates above the limit with one kept before
    it. An unknown correlation is no redundancy; names without a strength come
    last and are kept unfiltered."""
    places = ranked.select("series_id", "name", "strength", F.row_number().over(Window.partitionBy("series_id").orderBy(F.desc_nulls_last(round_to("strength", 9)), "name")).alias("place"))
    listed = places.where("strength is not null").groupBy("series_id").agg(F.sort_array(F.collect_list(F.struct("place", "name"))).alias("names"))
    high = pairs.where(F.abs("corr") > limit)
    clash = high.select("series_id", F.concat_ws("|", "a", "b").alias("pair")).unionByName(high.select("series_id", F.concat_ws("|", "b", "a").alias("pair")))
    clash = clash.groupBy("series_id").agg(F.collect_set("pair").alias("clashes"))
    joined = listed.join(clash, "series_id", "left").withColumn("clashes", F.coalesce("clashes", F.array().cast("array<string>")))

    def step(kept: Column, item: Column) -> Column:
        clashing = F.exists(kept, lambda k: F.array_contains(F.col("clashes"), F.concat_ws("|", k, item["name"])))
        return F.when(clashing, kept).otherwise(F.concat(kept, F.array(item["name"])))

    folded = joined.select("series_id", F.aggregate("names", F.array().cast("array<string>"), step).alias("kept_names"))
    out = places.join(folded, "series_id", "left")
    kept = F.col("strength").isNull() | F.coalesce(F.array_contains("kept_names", F.col("name")), F.lit(False))
    return out.select("series_id", "name", "strength", "place", kept.alias("kept"))


def top_n(scores: DataFrame, n: int) -> DataFrame:
    order = Window.partitionBy("series_id").orderBy(F.desc_nulls_last(round_to("score", 9)), "name")
    return scores.withColumn("chosen", F.row_number().over(order) <= n)


def above_threshold(scores: DataFrame, least: float) -> DataFrame:
    return scores.withColumn("chosen", F.coalesce(F.col("score") >= least, F.lit(False)))


def above_relative(scores: DataFrame, multiple: float = RELATIVE, cap: int | None = None) -> DataFrame:
    """At least `multiple` times an equal share 1/N, at most `cap` of them."""
    all_of = Window.partitionBy("series_id")
    out = scores.withColumn("chosen", F.coalesce(F.col("score") >= F.lit(multiple) / F.count("*").over(all_of), F.lit(False)))
    if cap is None:
        return out
    place = F.row_number().over(all_of.orderBy(F.col("chosen").desc(), F.desc_nulls_last("score"), "name"))
    return out.withColumn("chosen", F.col("chosen") & (place <= cap))


def above_correlation(scores: DataFrame, least: float = MIN_ABS_CORR) -> DataFrame:
    """scores has corr, that of the lagged driver with the price."""
    return scores.withColumn("chosen", F.coalesce(F.abs("corr") > least, F.lit(False)))


SHARE_MODES = {"top_n": top_n, "threshold": above_threshold, "relative_threshold": above_relative, "correlation": above_correlation}


def select_by(mode: str, scores: DataFrame, *args) -> DataFrame:
    if mode not in SHARE_MODES:
        raise ValueError(f"selection mode is one of {sorted(SHARE_MODES)}, not {mode!r}")
    return SHARE_MODES[mode](scores, *args)


def any_criterion(criteria: dict[str, DataFrame]) -> DataFrame:
    """(series_id, name, criterion, n_criteria): names that any criterion chose, with the
    first that did, in the order given."""
    marked = [df.where("chosen").select("series_id", "name", F.lit(i).alias("order"), F.lit(label).alias("label")) for i, (label, df) in enumerate(criteria.items())]
    union = marked[0]
    for df in marked[1:]:
        union = union.unionByName(df)
    return union.groupBy("series_id", "name").agg(F.min_by("label", "order").alias("criterion"), F.count_distinct("order").alias("n_criteria"))


def apply_overrides(pool: DataFrame, chosen: DataFrame, overrides: DataFrame) -> DataFrame:
    """(series_id, name, origin): what was chosen or must be included, without what is
    force excluded. overrides: series_id, must_include array, force_exclude array;
    'ALL' in must_include takes the whole pool."""
    rows = pool.select("series_id", "name").join(chosen.select("series_id", "name", F.lit(True).alias("picked")), ["series_id", "name"], "left").join(overrides, "series_id", "left")
    must = F.coalesce(F.array_contains("must_include", F.col("name")) | F.array_contains("must_include", F.lit("ALL")), F.lit(False))
    never = F.coalesce(F.array_contains("force_exclude", F.col("name")), F.lit(False))
    picked = F.coalesce("picked", F.lit(False))
    return rows.where((picked | must) & ~never).select("series_id", "name", F.when(picked, "selected").otherwise("manual").alias("origin"))


def exchange_rate_net(final: DataFrame, candidates: DataFrame) -> DataFrame:
    """Adds the strongest other candidate where the one survivor of a series is an
    exchange rate. candidates: series_id, name, strength."""
    lone = final.groupBy("series_id").agg(F.count("*").alias("n"), F.min("name").alias("only")).where((F.col("n") == 1) & is_exchange_rate("only"))
    best = candidates.join(lone, "series_id").where("name <> only and strength is not null")
    best = best.groupBy("series_id").agg(F.max_by("name", F.struct(round_to("strength", 9), "name")).alias("name"))
    return final.select("series_id", "name", "origin").unionByName(best.select("series_id", "name", F.lit("safety_net").alias("origin")))


def normalise(scores: DataFrame, column: str, out: str) -> DataFrame:
    """Shares of a series' total; untouched where that is not positive."""
    total = F.sum(column).over(Window.partitionBy("series_id"))
    return scores.withColumn(out, F.when(total > 0, F.col(column) / total).otherwise(F.col(column)))


def cumulative_cut(scores: DataFrame, share: float = 0.7) -> DataFrame:
    """Highest scores first until their sum reaches the share, the crossing row included."""
    order = Window.partitionBy("series_id").orderBy(F.desc("score"), "name")
    so_far = F.sum("score").over(order.rowsBetween(Window.unboundedPreceding, 0))
    return scores.withColumn("cumulative", so_far).withColumn("chosen", F.coalesce(so_far - F.col("score") < share, F.lit(False)))


def stability(ranks: DataFrame) -> DataFrame:
    """(series_id, name, stability): 1 minus the spread of a name's ranks over seeds,
    as a share of the number of names, between 0 and 1. ranks: series_id, name, seed, rank."""
    n = ranks.groupBy("series_id").agg(F.count_distinct("name").alias("n"))
    spread = ranks.groupBy("series_id", "name").agg(F.stddev_pop("rank").alias("spread")).join(n, "series_id")
    return spread.select("series_id", "name", F.least(F.lit(1.0), F.greatest(F.lit(0.0), 1 - F.col("spread") / F.col("n"))).alias("stability"))
