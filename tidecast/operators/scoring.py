"""Composite score, ranking and recommendation of techniques."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import clip_0_100, one_decimal, round_to, signed, tier
from ..plans.config import HORIZON_DISPLAY, Scoring

KEY = ["series_id", "technique", "horizon"]


def _round_trip(c):
    return round_to(c, 4)


def dynamism(detail: DataFrame) -> DataFrame:
    """(key, dynamism, predicted_cv_pct): how far the spread of predictions relative to
    their mean matches that of actuals, averaged over windows where both exist."""
    cv = lambda c: F.when((F.count(c) >= 2) & (F.avg(c) != 0), F.stddev_samp(c) / F.abs(F.avg(c)))
    windows = detail.groupBy(*KEY, "window_no").agg(cv("predicted").alias("cv_p"), cv("actual").alias("cv_a"), F.count("actual").alias("n_actual"))
    match = F.when(F.col("cv_a") > 0, clip_0_100(100 * (1 - F.abs(F.col("cv_p") - F.col("cv_a")) / F.col("cv_a"))))
    return windows.where("n_actual > 0").groupBy(*KEY).agg(F.avg(match).alias("dynamism"), F.avg(F.col("cv_p") * 100).alias("predicted_cv_pct"))


def score(detail: DataFrame, summary: DataFrame, prices: DataFrame, techniques: DataFrame, gate: DataFrame | None = None, cfg: Scoring = Scoring(), disqualify: bool = True) -> DataFrame:
    """One row a (series, technique, horizon). techniques: technique, bucket,
    eligibility; techniques that it lacks count as "yes". gate: series_id,
    technique, passed. A run without windows scores as insufficient history."""
    cycles = summary.where("months_evaluated > 0")
    recent = F.row_number().over(Window.partitionBy(*KEY).orderBy(F.desc("train_end")))
    cycles = cycles.withColumn("weight", F.when(recent <= cfg.recent_cycles, cfg.recent_weight).otherwise(1.0))
    direction = F.when(F.col("horizon") == "long", F.col("da_abs")).otherwise(F.col("da"))
    per_cycle = cycles.groupBy(*KEY).agg(
        F.count("*").cast("int").alias("evaluated_cycles"), F.avg(clip_0_100(direction)).alias("direction"), F.avg("mpe").alias("mean_mpe"),
        (F.sum(clip_0_100(100 - F.col("mape")) * F.col("weight")) / F.sum(F.when(F.col("mape").isNotNull(), F.col("weight")))).alias("recency"),
    )
    rows = detail.groupBy(*KEY).agg(F.avg(clip_0_100(F.col("accuracy"))).alias("accuracy"))
    bounds = prices.where("price is not null").groupBy("series_id").agg((F.min("price") * cfg.outlier_low).alias("low"), (F.max("price") * cfg.outlier_high).alias("high"))
    inside = detail.join(cycles.select(*KEY, "window_no"), [*KEY, "window_no"], "left_semi").join(bounds, "series_id")
    outliers = inside.groupBy(*KEY).agg(F.bool_or((F.col("predicted") < F.col("low")) | (F.col("predicted") > F.col("high"))).alias("outlier"))
    runs = summary.select(*KEY).distinct()
    named = techniques.select("technique", F.col("bucket").alias("horizon"), "eligibility")
    all_of = runs.join(F.broadcast(named), ["technique", "horizon"], "left").join(per_cycle, KEY, "left").join(rows, KEY, "left").join(dynamism(detail), KEY, "left").join(outliers, KEY, "left")
    if gate is not None:
        all_of = all_of.join(gate.select("series_id", "technique", "passed"), ["series_id", "technique"], "left")
    else:
        all_of = all_of.withColumn("passed", F.lit(None).cast("boolean"))
    n = F.coalesce("evaluated_cycles", F.lit(0))
    enough = n >= cfg.min_cycles
    dyn = F.coalesce("dynamism", F.lit(0.0))
    raw = (F.col("accuracy") * cfg.accuracy_weight + F.col("direction") * cfg.direction_weight + dyn * cfg.dynamism_weight + F.col("recency") * cfg.recency_weight) / 100
    flat = F.when((F.col("horizon") == "long") & (F.col("predicted_cv_pct") < cfg.flat_cv_pct), cfg.flat_points).otherwise(0.0)
    far = F.when(F.col("outlier"), cfg.outlier_points).otherwise(0.0)
    bias = F.when(F.abs("mean_mpe") > cfg.bias_pct, cfg.bias_points).otherwise(0.0)
    both_low = enough & (F.col("accuracy") < cfg.fail_accuracy) & (F.col("direction") < cfg.fail_direction)
    reasons = F.array_compact(F.array(
        F.when(F.col("eligibility") == "no", "horizon_ineligible_technique"),
        F.when((F.col("eligibility") == "gated") & (F.col("horizon") == "long") & ~F.coalesce("passed", F.lit(False)), "long_term_ext_var_model_without_robustness_gate_pass"),
        F.when(both_low, "mape_accuracy_below_threshold"), F.when(both_low, "directional_accuracy_below_threshold"),
    ))
    soft = F.array_compact(F.array(
        F.when(F.col("accuracy") < cfg.eligible_accuracy, "mape_accuracy_below_eligibility_threshold"),
        F.when(F.col("direction") < cfg.eligible_direction, "directional_accuracy_below_eligibility_threshold"),
    ))
    out = all_of.select(
        *KEY, n.alias("evaluated_cycles"), (~enough).alias("insufficient_history"), reasons.alias("disqualification_reasons"),
        F.when(enough, soft).otherwise(F.array(F.lit("insufficient_evaluated_cycles"))).alias("ineligibility_reasons"),
        *(F.when(enough, F.col(c)).alias(c) for c in ("accuracy", "direction")), F.when(enough, dyn).alias("dynamism"), F.when(enough, F.col("recency")).alias("recency"),
        F.when(enough, flat).otherwise(0.0).alias("flat_penalty"), F.when(enough, far).otherwise(0.0).alias("outlier_penalty"), F.when(enough, bias).otherwise(0.0).alias("bias_penalty"),
        F.when(enough, F.col("mean_mpe")).alias("mean_mpe"), F.when(enough, raw + flat + far + bias).alias("_raw"),
    )
    failed = F.size("disqualification_reasons") > 0
    total = F.when(F.col("insufficient_history") | (failed if disqualify else F.lit(False)), 0.0).otherwise(_round_trip(F.greatest(F.lit(float(cfg.floor)), F.col("_raw"))))
    out = out.withColumn("disqualified", failed).withColumn("composite", total)
    out = out.withColumn("eligible", ~F.col("disqualified") & (F.size("ineligibility_reasons") == 0))
    return out.withColumn("tier", F.when(~F.col("disqualified") & ~F.col("insufficient_history"), tier(F.col("composite"), cfg.tier_high, cfg.tier_medium))).drop("_raw")


def ranked(scores: DataFrame, order: DataFrame) -> DataFrame:
    """Adds rank 1..N by falling composite; ties keep the order of execution."""
    rows = scores.join(F.broadcast(order.select("technique", "display_name", "exec_order").distinct()), "technique", "left")
    rows = rows.withColumn("display_name", F.coalesce("display_name", "technique"))
    place = Window.partitionBy("series_id", "horizon").orderBy(F.desc("composite"), F.asc_nulls_last("exec_order"), "technique")
    return rows.withColumn("rank", F.row_number().over(place))


def best_two(ranks: DataFrame) -> DataFrame:
    """Best and runner-up among eligible techniques: one row a (series, horizon)."""
    rows = ranks.withColumn("pick", F.when(F.col("eligible"), F.row_number().over(Window.partitionBy("series_id", "horizon", "eligible").orderBy("rank"))))
    fields = F.struct("technique", "display_name", "accuracy", "direction", "dynamism", "recency", "composite", "tier", "flat_penalty", "outlier_penalty", "bias_penalty", "mean_mpe")
    return rows.groupBy("series_id", "horizon").agg(F.count_if("eligible").alias("n_eligible"), F.max(F.when(F.col("pick") == 1, fields)).alias("best"), F.max(F.when(F.col("pick") == 2, fields)).alias("runner_up"))


# The wording of a recommendation, and the scores that it calls strong.
NO_TECHNIQUE = "No technique met the eligibility thresholds for this series and horizon."


def key_reason(cfg: Scoring = Scoring()):
    """The sentence that explains a recommendation, out of best_two's columns."""
    b, r = (lambda c: F.col(f"best.{c}")), (lambda c: F.col(f"runner_up.{c}"))
    head = F.concat(F.lit("Highest composite score ("), one_decimal(b("composite")), F.lit(", "), b("tier"), F.lit(") among "), F.col("n_eligible").cast("string"), F.when(F.col("n_eligible") == 1, " eligible technique.").otherwise(" eligible techniques."))
    strong = F.array_compact(F.array(
        F.when(b("accuracy") >= cfg.strong_accuracy, F.concat(F.lit("strong MAPE accuracy ("), one_decimal(b("accuracy")), F.lit("%)"))),
        F.when(b("direction") >= cfg.strong_direction, F.concat(F.lit("strong directional accuracy ("), one_decimal(b("direction")), F.lit("%)"))),
        F.when(b("dynamism") >= cfg.strong_dynamism, F.concat(F.lit("healthy forecast dynamism ("), one_decimal(b("dynamism")), F.lit(")"))),
    ))
    notes = F.array_compact(F.array(
        F.when(b("flat_penalty") != 0, F.concat(F.lit("flat-line penalty ("), signed(b("flat_penalty")), F.lit(")"))),
        F.when(b("outlier_penalty") != 0, F.concat(F.lit("outlier-cap penalty ("), signed(b("outlier_penalty")), F.lit(")"))),
        F.when(b("bias_penalty") != 0, F.concat(F.lit("normalized-bias penalty ("), signed(b("bias_penalty")), F.lit(", mean MPE "), one_decimal(b("mean_mpe")), F.lit("%)"))),
    ))
    driven = F.when(F.size(strong) > 0, F.concat(F.lit("Driven by "), F.array_join(strong, ", "), F.lit(".")))
    noted = F.when(F.size(notes) > 0, F.concat(F.lit("Note: "), F.array_join(notes, ", "), F.lit(" applied.")))
    trails = F.when(F.col("runner_up").isNotNull(), F.concat(F.lit("Runner-up ("), r("display_name"), F.lit(", "), one_decimal(r("composite")), F.lit(") trails by "), one_decimal(b("composite") - r("composite")), F.lit(" points.")))
    return F.when(F.col("best").isNull(), NO_TECHNIQUE).otherwise(F.concat_ws(" ", head, driven, noted, trails))


def recommend(ranks: DataFrame) -> DataFrame:
    """(series_id, horizon, n_eligible, best, runner_up, key_reason, status)."""
    status = F.when(F.col("best").isNull(), "Pending: no eligible technique to default to").otherwise("Pending (auto-defaulted to top score; awaiting analyst review)")
    return best_two(ranks).withColumn("key_reason", key_reason()).withColumn("status", status)


def _display(horizon):
    return F.coalesce(*(F.when(F.col(horizon) == k, v) for k, v in HORIZON_DISPLAY.items()), F.col(horizon))


def summary_table(ranks: DataFrame, regions: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The 21-column score summary: a benchmark row at rank 0 of every (series, horizon),
    blank where there is no benchmark score, then every technique. regions:
    series_id, region. benchmark: scores of technique "benchmark" with benchmark_accuracy."""
    yes = lambda c: F.when(c, "Y").otherwise("N")
    accuracy = benchmark.select("series_id", "horizon", "benchmark_accuracy")
    spine = ranks.select("series_id", "horizon").distinct()
    fields = ("accuracy", "direction", "dynamism", "recency", "flat_penalty", "outlier_penalty", "composite")
    names = ("MAPE Accuracy %", "Directional Accuracy %", "Forecast Dynamism", "Recency Score", "Flat-line Penalty", "Outlier Penalty", "Composite Score")

    def table(df, technique, rank, eligible, why, known):
        when = lambda c: F.when(known, c)
        return df.select(
            F.col("series_id").alias("Commodity"), F.col("region").alias("Region"), _display("horizon").alias("Horizon"), technique.alias("Technique"),
            when(yes(~F.col("disqualified"))).alias("Eligible (Y/N)"), when(F.array_join("disqualification_reasons", "; ")).alias("Disqualification Reason"),
            *(F.col(f).alias(n) for f, n in zip(fields, names)), rank.alias("Rank"), eligible.alias("Eligible For Recommendation (Y/N)"), why.alias("Ineligibility Reason"),
            F.col("bias_penalty").alias("Normalized Bias Penalty"), F.col("mean_mpe").alias("Mean MPE (%)"), F.col("evaluated_cycles").alias("Evaluated Cycles"),
            when(yes(F.col("insufficient_history"))).alias("Insufficient History (Y/N)"), F.col("benchmark_accuracy").alias("Benchmark Accuracy (%)"),
        )

    own = ranks.join(accuracy, ["series_id", "horizon"], "left").join(regions, "series_id", "left")
    first = spine.join(benchmark.drop("technique"), ["series_id", "horizon"], "left").join(regions, "series_id", "left")
    top = table(first, F.lit("Benchmark"), F.lit(0), F.lit("N"), F.lit("not_a_recommendable_technique"), F.col("composite").isNotNull())
    return top.unionByName(table(own, F.col("display_name"), F.col("rank"), yes(F.col("eligible")), F.array_join("ineligibility_reasons", "; "), F.lit(True)))


def forecast_rows(recommended: DataFrame) -> DataFrame:
    """One row a (series, horizon) with the Best and Runner-Up blocks."""

    def block(prefix: str, c: str):
        parts = (("MAPE Accuracy %", "accuracy"), ("Directional Accuracy %", "direction"), ("Forecast Dynamism", "dynamism"), ("Recency Score", "recency"), ("Composite Score", "composite"))
        return [F.col(f"{c}.display_name").alias(f"{prefix} Technique"), *(F.col(f"{c}.{f}").alias(f"{prefix} - {n}") for n, f in parts)]

    return recommended.select(
        F.col("series_id").alias("Commodity"), _display("horizon").alias("Horizon"), *block("Best", "best"), *block("Runner-Up", "runner_up"),
        F.col("best.tier").alias("Confidence Tier"), F.col("key_reason").alias("Key Reason"), F.col("status").alias("Decision Log Status"),
    )
