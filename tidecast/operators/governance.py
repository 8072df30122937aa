"""Decisions, selection history and the model registry, as append-only or upserted tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

LOG = "series_id string, horizon string, action string, technique string, analyst string, justification string, ts timestamp"
HISTORY = "series_id string, region string, horizon string, forecast_cycle string, technique string, action string, analyst string, ts timestamp"


def empty_log(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], LOG)


def empty_history(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], HISTORY)


def read_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A table, or an empty one of the schema where there is none yet."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    there = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)
    return spark.read.schema(schema).parquet(path) if there else spark.createDataFrame([], schema)


def confirm(log: DataFrame, recommended: DataFrame, requests: DataFrame) -> DataFrame:
    """The log with each request (series_id, horizon, analyst, ts) that confirms the
    best technique. Requests without an analyst, or where nothing is best, are an error."""
    rows = requests.join(recommended.select("series_id", "horizon", F.col("best.technique").alias("technique")), ["series_id", "horizon"], "left")
    bad = F.col("technique").isNull() | (F.coalesce(F.trim("analyst"), F.lit("")) == "")
    rows = rows.withColumn("action", F.when(bad, F.raise_error(F.lit("a confirmation needs an eligible best technique and an analyst"))).otherwise("Confirmed"))
    return log.unionByName(rows.select("series_id", "horizon", "action", "technique", "analyst", F.lit("").alias("justification"), "ts"))


def override(log: DataFrame, techniques: DataFrame, requests: DataFrame) -> DataFrame:
    """The log with each request (series_id, horizon, technique, analyst,
    justification, ts); unknown techniques and empty justifications are an error."""
    rows = requests.join(F.broadcast(techniques.select("technique").distinct().withColumn("known", F.lit(True))), "technique", "left")
    bad = F.col("known").isNull() | (F.coalesce(F.trim("justification"), F.lit("")) == "") | (F.coalesce(F.trim("analyst"), F.lit("")) == "")
    rows = rows.withColumn("action", F.when(bad, F.raise_error(F.lit("an override needs a known technique, a justification and an analyst"))).otherwise("Overridden"))
    return log.unionByName(rows.select("series_id", "horizon", "action", "technique", "analyst", "justification", "ts"))


def current_decisions(log: DataFrame, recommended: DataFrame) -> DataFrame:
    """(series_id, horizon, action, technique, analyst, justification, ts, status): the
    latest logged row, else the recommendation as Pending."""
    row = F.struct("ts", "action", "technique", "analyst", "justification")
    latest = log.groupBy("series_id", "horizon").agg(F.max(row).alias("d"))
    out = recommended.select("series_id", "horizon", F.col("best.technique").alias("best")).join(latest, ["series_id", "horizon"], "full")
    action = F.coalesce("d.action", F.lit("Pending"))
    told = F.concat(F.col("d.action"), F.lit(" by "), F.col("d.analyst"), F.lit(" on "), F.date_format("d.ts", "dd-MMM-yyyy"))
    none = F.when(F.col("best").isNull(), "Pending: no eligible technique to default to").otherwise("Pending (auto-defaulted to top score; awaiting analyst review)")
    return out.select("series_id", "horizon", action.alias("action"), F.coalesce("d.technique", "best").alias("technique"), F.col("d.analyst").alias("analyst"), F.col("d.justification").alias("justification"), F.col("d.ts").alias("ts"), F.coalesce(told, none).alias("status"))


def record_selection(history: DataFrame, decisions: DataFrame, regions: DataFrame, cycle: str, ts) -> DataFrame:
    """History with this cycle's rows put in place of earlier ones of the same
    (series, horizon, cycle). A decision without a technique is an error."""
    technique = F.when(F.col("technique").isNull(), F.raise_error(F.lit("a selection needs a technique"))).otherwise(F.col("technique"))
    rows = decisions.join(regions, "series_id", "left").select("series_id", "region", "horizon", F.lit(cycle).alias("forecast_cycle"), technique.alias("technique"), "action", "analyst", F.lit(ts).cast("timestamp").alias("ts"))
    kept = history.join(rows.select("series_id", "horizon", "forecast_cycle"), ["series_id", "horizon", "forecast_cycle"], "left_anti")
    return kept.select(*rows.columns).unionByName(rows)


def default_technique(history: DataFrame) -> DataFrame:
    """(series_id, horizon, technique) of the latest recorded selection."""
    return history.groupBy("series_id", "horizon").agg(F.max(F.struct("ts", "forecast_cycle", "technique")).alias("h")).select("series_id", "horizon", F.col("h.technique").alias("technique"))


def replace_series(existing: DataFrame, fresh: DataFrame) -> DataFrame:
    """Accumulated rows with those of the fresh table's series replaced."""
    return existing.join(fresh.select("series_id").distinct(), "series_id", "left_anti").unionByName(fresh, allowMissingColumns=True)


def savable_models(ranks: DataFrame, unsupported: list[str], top: int = 3) -> DataFrame:
    """The top techniques that can be saved, ranked after the filter so that ranks have no holes."""
    rows = ranks.where(~F.col("technique").isin(unsupported) & ~F.col("disqualified"))
    place = F.row_number().over(Window.partitionBy("series_id", "horizon").orderBy("rank"))
    return rows.withColumn("saved_rank", place).where(F.col("saved_rank") <= top)


def latest_models(registry: DataFrame) -> DataFrame:
    """The newest registry row of each (series, horizon, rank)."""
    place = F.row_number().over(Window.partitionBy("series_id", "horizon", "rank").orderBy(F.desc("saved_at"), "technique"))
    return registry.withColumn("_place", place).where("_place = 1").drop("_place")


def final_forecast_rows(forecast: DataFrame, decisions: DataFrame, ranks: DataFrame) -> DataFrame:
    """The forecast row with its Best block replaced by the decided technique; metrics
    are null where it was never scored. Series without a technique are left out."""
    scored = ranks.select("series_id", "horizon", "technique", "display_name", "accuracy", "direction", "dynamism", "recency", "composite", "tier")
    decided = decisions.where("technique is not null").select("series_id", "horizon", "technique", F.col("status").alias("decided")).join(scored, ["series_id", "horizon", "technique"], "left")
    rows = forecast.join(decided, ["series_id", "horizon"])
    best = F.struct(F.coalesce("display_name", "technique").alias("display_name"), "technique", "accuracy", "direction", "dynamism", "recency", "composite", "tier")
    return rows.withColumn("best", best).withColumn("status", F.col("decided")).select("series_id", "horizon", "best", "runner_up", "key_reason", "status")
