"""Helpers that the corpus operators share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.shared import Scratch, drop_path, shared_dir

__all__ = ["Scratch", "batch_rows", "carried", "crc32_of_id", "drop_path", "shared_dir", "table"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def carried(extra: tuple[str, ...], *own: str) -> tuple[str, ...]:
    """The extra columns without those that have the name of a result's own column."""
    return tuple(c for c in extra if c.lower() not in {o.lower() for o in own})


def crc32_of_id(column: str = "doc_id"):
    """crc32 of the decimal text of an id, as the fold rules use it."""
    return F.crc32(F.col(column).cast("string"))


def batch_rows(batch, limit_bytes: int = 16 << 20):
    """Slices of a record batch whose buffers stay near limit_bytes."""
    n = max(1, batch.num_rows)
    step = max(1, int(n * limit_bytes / max(1, batch.nbytes)))
    for at in range(0, batch.num_rows, step):
        yield batch.slice(at, step)
