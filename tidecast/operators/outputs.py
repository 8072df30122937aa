"""Sinks: review and final output, immutable snapshots, accumulate-and-replace tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import round_to

STAGES = ("review", "final")


def display_rounded(df: DataFrame, places: int = 1) -> DataFrame:
    """Doubles to one decimal, for what people read; stored tables keep full values."""
    cut = lambda f: round_to(F.col(f"`{f.name}`"), places).alias(f.name) if isinstance(f.dataType, T.DoubleType) else F.col(f"`{f.name}`")
    return df.select(*(cut(f) for f in df.schema.fields))


def write_stage(df: DataFrame, root: str, table: str, stage: str, by: tuple[str, ...] = ("series_id", "horizon")) -> str:
    """The rows of a run under root/table/stage, partitioned; only the partitions
    that the rows touch are replaced."""
    if stage not in STAGES:
        raise ValueError(f"stage is one of {STAGES}, not {stage!r}")
    path = f"{root}/{table}/stage={stage}"
    df.repartition(*by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)
    return path


def write_snapshot(df: DataFrame, root: str, table: str, run_ts: str) -> str:
    """An immutable copy of a final output, kept under its run's time; a run that is there already is an error."""
    path = f"{root}/{table}_history/run_ts={run_ts}"
    df.write.mode("errorifexists").parquet(path)
    return path


def write_output(forecast: DataFrame, summary: DataFrame, root: str, stage: str, run_ts: str | None = None) -> list[str]:
    """Forecast rows and score summaries of a stage; a final stage also gets its snapshot."""
    out = [write_stage(forecast, root, "forecast", stage), write_stage(summary, root, "summary", stage)]
    if stage == "final":
        if run_ts is None:
            raise ValueError("a final output needs run_ts")
        out += [write_snapshot(forecast, root, "forecast", run_ts), write_snapshot(summary, root, "summary", run_ts)]
    return out


def final_summary(ranks: DataFrame, decisions: DataFrame) -> DataFrame:
    """The decided technique's rows of the ranking; benchmark rows are added by summary_table."""
    return ranks.join(decisions.where("technique is not null").select("series_id", "horizon", "technique"), ["series_id", "horizon", "technique"], "left_semi")


def write_consolidated(df: DataFrame, root: str, table: str) -> str:
    """A cross-series table in which a run replaces the series that it covers."""
    path = f"{root}/{table}"
    df.repartition("series_id").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("series_id").parquet(path)
    return path


def write_insert_if_absent(fresh: DataFrame, existing: DataFrame, path: str, keys: tuple[str, ...]) -> str:
    """Appends only rows whose keys the table lacks: candidate configurations are never overwritten."""
    fresh.join(existing.select(*keys), list(keys), "left_anti").write.mode("append").parquet(path)
    return path


def write_csv(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").option("header", True).csv(path)
    return path


def write_benchmark_views(tables: dict[str, DataFrame], root: str) -> list[str]:
    """Each non-empty view of the benchmark under its own name."""
    out = []
    for name, df in tables.items():
        if df.limit(1).count():
            df.write.mode("overwrite").parquet(f"{root}/benchmark/{name}")
            out.append(name)
    return out


def append_flags(flags: DataFrame, path: str, run_ts: str) -> str:
    flags.withColumn("run_ts", F.lit(run_ts)).write.mode("append").parquet(path)
    return path


def selected_driver_rows(dim_series: DataFrame, selected: DataFrame) -> DataFrame:
    """Registry with the status of series that have selected drivers set to 'selected'."""
    done = selected.select("series_id").distinct().withColumn("done", F.lit(True))
    return dim_series.join(done, "series_id", "left").withColumn("drivers_status", F.when(F.col("done"), "selected").otherwise(F.col("drivers_status"))).drop("done")
