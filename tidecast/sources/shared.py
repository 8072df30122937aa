"""Intermediate tables in the folder that the driver and all executors share."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_OWN: dict[int, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; where that is unset and the master is local
    (tests), a temporary one. Without it a cluster run is an error."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    key = id(spark.sparkContext)
    if key not in _OWN:
        _OWN[key] = "file://" + tempfile.mkdtemp(prefix="tidecast-")
    return _OWN[key]


def drop_path(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def _drop_quietly(spark: SparkSession, path: str) -> None:
    try:
        drop_path(spark, path)
    except Exception:  # the session has ended, and with it the run
        pass


class Scratch:
    """Tables written to the shared folder: they cut lineage, outlive lost
    executors, and are deleted with drop() or when the driver ends."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
        self.n = 0
        atexit.register(_drop_quietly, spark, self.root)

    def save(self, df: DataFrame) -> DataFrame:
        self.n += 1
        path = f"{self.root}/{self.n}"
        df.write.option("compression", "zstd").parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._scratch_path = path
        return out

    def drop(self, df: DataFrame) -> None:
        if path := getattr(df, "_scratch_path", None):
            drop_path(self.spark, path)
