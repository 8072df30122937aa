"""Report tables of a run: driver selection, run times, the consolidated sheets, the run log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import outputs


def _listed(df: DataFrame, prefix: str, order: str = "name") -> DataFrame:
    """(series_id, <prefix>_count, <prefix>_names): names joined in the order given."""
    rows = F.sort_array(F.collect_list(F.struct(F.col(order).alias("o"), "name")))
    names = F.array_join(F.transform(rows, lambda r: r["name"]), "; ")
    return df.groupBy("series_id").agg(F.count("*").alias(f"{prefix}_count"), names.alias(f"{prefix}_names"))


def driver_selection_report(series: DataFrame, candidates: DataFrame, selected: DataFrame, survival: DataFrame, survival_ext: DataFrame | None = None) -> DataFrame:
    """One row a series: candidate and selected drivers, and the engineered features that
    both cuts keep for models without and with drivers. series: series_id, region;
    candidates: series_id, column_no, name; selected: series_id, name. A series without
    drivers has the same features in both."""
    total = survival.groupBy("series_id").agg(F.count("*").alias("total_features"))
    own = _listed(survival.where("kept"), "kept")
    ext = own if survival_ext is None else _listed(survival_ext.where("kept"), "kept")
    ext = ext.select("series_id", F.col("kept_count").alias("kept_ext_count"), F.col("kept_names").alias("kept_ext_names"))
    out = series.select("series_id", "region")
    for df in (_listed(candidates, "candidate", "column_no"), _listed(selected, "selected"), total, own, ext):
        out = out.join(df, "series_id", "left")
    number = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    text = lambda c: F.coalesce(c, F.lit("")).alias(c)
    return out.select("series_id", "region", *(f(c) for c in ("candidate", "selected") for f, c in ((number, f"{c}_count"), (text, f"{c}_names"))), number("total_features"), *(f(c) for c in ("kept", "kept_ext") for f, c in ((number, f"{c}_count"), (text, f"{c}_names"))))


def runtime_report(forecasts: DataFrame, regions: DataFrame, techniques: DataFrame) -> DataFrame:
    """(series_id, region, horizon, model, fits, seconds): the time that the fits of a series,
    horizon and technique took together. forecasts: as run_batch returns them; a fit's
    time stands on each of its rows and counts once."""
    fits = forecasts.groupBy("series_id", "horizon", "technique", "window_no").agg(F.max("seconds").alias("seconds"))
    total = fits.groupBy("series_id", "horizon", "technique").agg(F.count("*").alias("fits"), F.round(F.sum("seconds"), 3).alias("seconds"))
    names = techniques.select("technique", "display_name").distinct()
    return total.join(names, "technique", "left").join(regions.select("series_id", "region"), "series_id", "left").select("series_id", "region", "horizon", F.coalesce("display_name", "technique").alias("model"), "fits", "seconds")


#: Column names of the scoring sheet, as people read them.
SCORING_COLUMNS = {
    "series_id": "Series", "region": "Region", "horizon": "Horizon", "display_name": "Technique", "accuracy": "MAPE Accuracy %", "direction": "Directional Accuracy %", "dynamism": "Forecast Dynamism",
    "recency": "Recency Score", "composite": "Composite Score", "rank": "Rank", "tier": "Confidence", "eligible": "Eligible",
}


def scoring_report(ranks: DataFrame, regions: DataFrame) -> DataFrame:
    """The twelve columns of the scoring sheet under their display names."""
    rows = ranks.join(regions.select("series_id", "region"), "series_id", "left")
    return rows.select(*(F.col(c).alias(name) for c, name in SCORING_COLUMNS.items()))


def horizon_report(detail: DataFrame, techniques: DataFrame, regions: DataFrame) -> DataFrame:
    """Every evaluated step of all horizons beside its technique's display name and the region."""
    names = techniques.select("technique", "display_name").distinct()
    rows = detail.join(names, "technique", "left").join(regions.select("series_id", "region"), "series_id", "left")
    return rows.select("series_id", "region", "horizon", F.coalesce("display_name", "technique").alias("model"), "window_no", "train_end", "step", "ds", "predicted", "actual", "ape", "accuracy", "flag")


def write_consolidated_reports(sheets: dict[str, DataFrame], root: str) -> list[str]:
    """The sheets of a run (data, scoring, drivers, runtime, ...), each a table in which a
    run replaces the series that it covers. A sheet needs a series_id."""
    missing = [name for name, df in sheets.items() if "series_id" not in df.columns]
    if missing:
        raise ValueError(f"no series_id in {', '.join(missing)}")
    return [outputs.write_consolidated(df, f"{root}/consolidated", name) for name, df in sheets.items()]


def final_output(forecast: DataFrame, ranks: DataFrame, decisions: DataFrame, benchmark: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(forecast, summary) for readers outside: the decided technique's row of each series
    and horizon, and its scores beside the benchmark's. A decision without a technique
    is an error; a technique that was never scored says so. forecast: as
    governance.final_forecast_rows; benchmark: rows like ranks."""
    checked = F.when(F.col("technique").isNull(), F.raise_error(F.concat(F.lit("nothing decided for "), F.col("series_id"), F.lit(" "), F.col("horizon")))).otherwise(F.col("technique"))
    decided = decisions.select("series_id", "horizon", checked.alias("technique"))
    columns = ["display_name", "eligible", "accuracy", "direction", "dynamism", "recency", "flat_penalty", "outlier_penalty", "composite", "rank"]
    rows = decided.join(ranks.select("series_id", "horizon", "technique", *columns, F.lit(True).alias("scored")), ["series_id", "horizon", "technique"], "left")
    status: Column = F.when(F.col("scored"), F.when(F.col("eligible"), "Y").otherwise("N")).otherwise("Not Scored")
    summary = rows.select("series_id", "horizon", F.coalesce("display_name", "technique").alias("model"), status.alias("status"), *columns[2:])
    if benchmark is not None:
        other = benchmark.join(decided.select("series_id", "horizon"), ["series_id", "horizon"], "left_semi")
        summary = summary.unionByName(other.select("series_id", "horizon", F.lit("Benchmark").alias("model"), F.when(F.col("eligible"), "Y").otherwise("N").alias("status"), *(F.col(c) if c in benchmark.columns else F.lit(None).cast("int").alias(c) for c in columns[2:])))
    return forecast.join(decided.select("series_id", "horizon"), ["series_id", "horizon"], "left_semi"), summary


def append_log(events: list[tuple[str, str, str]], spark, path: str, run_ts: str) -> str:
    """Appends (stage, level, message) events of a run to the log table, one file a call."""
    rows = [(run_ts, i, *e) for i, e in enumerate(events)]
    spark.createDataFrame(rows, "run_ts string, place int, stage string, level string, message string").coalesce(1).write.mode("append").parquet(path)
    return path


def run_summary(out: dict[str, DataFrame | None]) -> DataFrame:
    """(stage, series, rows, failed) of the tables that a run returned."""
    parts = []
    for name in ("windows", "selected", "forecasts", "detail", "ranks"):
        df = out.get(name)
        if df is not None:
            failed = F.count_if(F.col("error").isNotNull()) if "error" in df.columns else F.lit(0).cast("long")
            parts.append(df.agg(F.lit(name).alias("stage"), F.count_distinct("series_id").alias("series"), F.count("*").alias("rows"), failed.alias("failed")))
    done = parts[0]
    for df in parts[1:]:
        done = done.unionByName(df)
    return done
