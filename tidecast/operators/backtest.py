"""Backtests: forecast rows to metrics, window summaries and vintage matrices.

Kernels return (series_id, technique, window_no, step, predicted); everything
after them is relational, over all series at once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import direction_hit, month_label, round_to, row_metrics

RUN = ["series_id", "technique", "horizon", "window_no"]


def naive_forecasts(prices: DataFrame, windows: DataFrame, m_end: int, season: int = 12) -> DataFrame:
    """Last value, seasonal last value and drift, as baselines that need no kernel."""
    rows = prices.where("price is not null").select("series_id", "ds", "price")
    known = rows.join(windows.select("series_id", "window_no", "train_end"), "series_id").where("ds <= train_end")
    last = known.groupBy("series_id", "window_no", "train_end").agg(F.max_by("price", "ds").alias("last"), F.min_by("price", "ds").alias("first"), F.count("*").alias("n"))
    steps = last.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(m_end)))).withColumn("ds", F.add_months("train_end", F.col("step")))
    source = F.add_months("ds", -season * F.ceil(F.col("step") / season).cast("int"))
    old = rows.select("series_id", F.col("ds").alias("source"), F.col("price").alias("season_price"))
    seasonal = steps.withColumn("source", source).join(old, ["series_id", "source"], "left")
    drift = F.col("last") + F.col("step") * (F.col("last") - F.col("first")) / F.nullif(F.col("n") - 1, F.lit(0))
    made = F.array(
        F.struct(F.lit("last_value").alias("technique"), F.col("last").alias("predicted")),
        F.struct(F.lit("seasonal_naive").alias("technique"), F.coalesce("season_price", "last").alias("predicted")),
        F.struct(F.lit("drift").alias("technique"), F.coalesce(drift, F.col("last")).alias("predicted")),
    )
    return seasonal.select("series_id", "window_no", "train_end", "step", "ds", F.explode(made).alias("m")).select("series_id", "m.technique", "window_no", "train_end", "step", "ds", round_to("m.predicted", 6).alias("predicted"))


def evaluate(forecasts: DataFrame, prices: DataFrame, horizon: str, m_start: int, m_end: int) -> DataFrame:
    """The detail table of one horizon; see evaluate_all."""
    return evaluate_all(forecasts, prices, {horizon: (m_start, m_end)})


def evaluate_all(forecasts: DataFrame, prices: DataFrame, spans: dict[str, tuple[int, int]]) -> DataFrame:
    """The detail table: forecast rows of each horizon's steps, which don't overlap, with
    actuals, both directional hits and row metrics, in one pass. The rolling baseline of a step is the
    prediction recorded before it, of the first recorded step (whatever the
    warm-up) the price at the window's end; steps without a prediction are left out."""
    actual = prices.where("price is not null").select("series_id", "ds", F.col("price").alias("actual"))
    start = actual.select("series_id", F.col("ds").alias("train_end"), F.col("actual").alias("anchor"))
    named = F.coalesce(*(F.when(F.col("step").between(*span), name) for name, span in spans.items()))
    rows = forecasts.where(F.col("predicted").isNotNull() & ~F.isnan("predicted")).withColumn("horizon", named).where("horizon is not null")
    rows = rows.join(actual, ["series_id", "ds"], "left").join(start, ["series_id", "train_end"], "left")
    before = F.coalesce(F.lag("predicted").over(Window.partitionBy(*RUN).orderBy("step")), F.col("anchor"))
    return rows.select(
        *RUN, "train_end", F.add_months("train_end", 1).alias("forecast_start"), "step", "ds", "predicted", "actual",
        direction_hit("actual", "predicted", before).alias("da_mom"), direction_hit("actual", "predicted", "anchor").alias("da_abs"),
        F.when(F.col("actual").isNotNull(), "Actual").otherwise("No Actual Yet").alias("flag"), *(c.alias(n) for n, c in row_metrics().items()),
    )


def summarise(detail: DataFrame) -> DataFrame:
    """One row a window; windows without actuals stay, with 0 months and null metrics."""
    per = lambda c: F.avg(F.when(F.col("flag") == "Actual", F.col(c)))
    return detail.groupBy(*RUN, "train_end", "forecast_start").agg(
        F.count_if(F.col("flag") == "Actual").cast("int").alias("months_evaluated"),
        per("mae").alias("mae"), F.sqrt(per("mse")).alias("rmse"), per("mape").alias("mape"), per("mpe").alias("mpe"), per("accuracy").alias("avg_accuracy"),
        (per("da_mom") * 100).alias("da"), (per("da_abs") * 100).alias("da_abs"),
    )


def vintage_matrix(detail: DataFrame, prices: DataFrame, windows: list[int]) -> DataFrame:
    """Wide table of one row a (series, technique, horizon, month): a column w<n> for each
    window number given, prices up to its training end and predictions after."""
    runs = detail.select(*RUN, "train_end").distinct()
    known = runs.join(prices.where("price is not null").select("series_id", "ds", "price"), "series_id").where("ds <= train_end").select(*RUN, "ds", F.col("price").alias("value"))
    rows = known.unionByName(detail.select(*RUN, "ds", F.col("predicted").alias("value")))
    key = ["series_id", "technique", "horizon", "ds"]
    return rows.groupBy(*key).agg(*(F.max(F.when(F.col("window_no") == w, F.col("value"))).alias(f"w{w}") for w in windows)).withColumn("period", month_label("ds"))


def search_best(trials: DataFrame) -> DataFrame:
    """The parameter set with the least mean error over windows, ties to the first, for
    each step where there is such a column.
    trials: series_id, technique, [step,] trial, params, window_no, error."""
    key = ["series_id", "technique", *(["step"] if "step" in trials.columns else [])]
    mean = trials.where("error is not null").groupBy(*key, "trial", "params").agg(F.avg("error").alias("loss"))
    place = F.row_number().over(Window.partitionBy(*key).orderBy(round_to("loss", 9), "trial"))
    return mean.withColumn("place", place).where("place = 1").drop("place")


def composite_loss(rows: DataFrame, keys: list[str], da_weight: float) -> DataFrame:
    """MAPE over non-zero actuals plus a weighted penalty for wrong directions (50 where
    no direction is known). rows: keys, actual, predicted, baseline."""
    hit = direction_hit("actual", "predicted", "baseline")
    mape = F.avg(F.when(F.col("actual") != 0, F.abs((F.col("actual") - F.col("predicted")) / F.col("actual")) * 100))
    penalty = F.coalesce((1 - F.avg(hit)) * 100, F.lit(50.0))
    return rows.groupBy(*keys).agg((mape + da_weight * penalty).alias("loss"))
