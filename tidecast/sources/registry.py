"""Series registry and driver catalogs from YAML to dimension tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import clean_name

SERIES = "series_id string, display_name string, grade string, region string, frequency string, start_period string, data_file string, drivers_status string"
DRIVERS = "series_id string, column_no int, label string, unit string, must_include array<string>, force_exclude array<string>"
FREQUENCIES, STATUSES = ("monthly", "quarterly"), ("candidates", "selected")


def read_yaml(spark: SparkSession, path: str) -> dict:
    """One YAML file of any store that Spark reads."""
    import yaml

    text = spark.read.text(path, wholetext=True).first()
    return (yaml.safe_load(text.value) if text else None) or {}


def validate_series(entry: dict) -> None:
    missing = [k for k in ("id", "display_name", "frequency", "start_period", "drivers_status") if not entry.get(k)]
    if missing:
        raise ValueError(f"series {entry.get('id')!r} lacks {', '.join(missing)}")
    if entry["frequency"] not in FREQUENCIES:
        raise ValueError(f"series {entry['id']!r}: frequency is one of {FREQUENCIES}")
    if entry["drivers_status"] not in STATUSES:
        raise ValueError(f"series {entry['id']!r}: drivers_status is one of {STATUSES}")


def dim_series(spark: SparkSession, entries: list[dict]) -> DataFrame:
    """Raises at the first invalid entry."""
    for e in entries:
        validate_series(e)
    rows = [(e["id"], e["display_name"], e.get("grade"), e.get("region"), e["frequency"], str(e["start_period"]), (e.get("data") or {}).get("file"), e["drivers_status"]) for e in entries]
    return spark.createDataFrame(rows, SERIES)


def dim_driver(spark: SparkSession, catalogs: list[dict]) -> DataFrame:
    """One row a candidate driver; 'ALL' in must_include stands for every driver."""
    rows = []
    for c in catalogs:
        must = c.get("must_include_drivers")
        must = [must] if isinstance(must, str) else must
        rows += [(c["series_id"], d["column"], d["label"], d.get("unit"), must, c.get("force_exclude_drivers")) for d in c.get("candidate_drivers") or []]
    return distinct_labels(spark.createDataFrame(rows, DRIVERS))


def distinct_labels(rows: DataFrame) -> DataFrame:
    """Adds name: the cleaned label; a second use gets its unit, a third its column number."""
    from pyspark.sql import Window

    rows = rows.withColumn("_clean", clean_name("label"))
    first = F.row_number().over(Window.partitionBy("series_id", "_clean").orderBy("column_no"))
    rows = rows.withColumn("_try", F.when(first == 1, F.col("_clean")).otherwise(clean_name(F.concat_ws("_", "_clean", "unit"))))
    again = F.row_number().over(Window.partitionBy("series_id", "_try").orderBy("column_no"))
    return rows.withColumn("name", F.when(again == 1, F.col("_try")).otherwise(F.concat("_clean", F.lit("_col"), F.col("column_no").cast("string")))).drop("_clean", "_try")
