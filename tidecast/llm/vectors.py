"""What the two vector operators share: valid vectors, packed blocks, block pairs."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK_ROWS = 4096


def read_vectors(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, valid, dim, key_high, key_low, vec): vec holds little-endian doubles.
    A vector that is null, empty, zero, or has a null or non-finite component is not
    valid and has no vec."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            valid, dim, high, low, vec = [], [], [], [], []
            for x in batch.column(1):
                v = None
                if x.is_valid and len(x.values) and not x.values.null_count:
                    v = np.asarray(x.values.to_numpy(zero_copy_only=False), "<f8") + 0.0  # -0.0 becomes 0.0
                    v = v if np.isfinite(v).all() and v.any() else None
                raw = v.tobytes() if v is not None else b""
                a, b = np.frombuffer(hashlib.md5(raw).digest(), "<i8").tolist()
                for column, value in zip((valid, dim, high, low, vec), (v is not None, len(raw) // 8, a, b, raw if v is not None else None)):
                    column.append(value)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(valid, pa.bool_()), pa.array(dim, pa.int32()), pa.array(high, pa.int64()), pa.array(low, pa.int64()), pa.array(vec, pa.binary())],
                ["id", "valid", "dim", "key_high", "key_low", "vec"],
            )

    return rows.select(F.col(id_col).cast("long").alias("id"), vector_col).mapInArrow(run, "id long, valid boolean, dim int, key_high long, key_low long, vec binary")


def scaled(vecs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows by powers of two so that the largest component is in [0.5, 1), which loses
    nothing, and the exponents: lengths of the rows neither overflow nor vanish."""
    exponent = np.frexp(np.abs(vecs).max(1, keepdims=True))[1] if vecs.size else np.zeros((len(vecs), 1), int)
    return np.ldexp(vecs, -exponent), exponent


def pack_blocks(vectors: DataFrame, block_rows: int, extra: str | None = None) -> tuple[DataFrame, int]:
    """One row (dim, block, ids, extra, vecs) for each block of about block_rows
    vectors of one dimension, dealt by a hash of id and extra; and the number of blocks."""
    blocks = max(1, math.ceil(vectors.count() / block_rows))
    extra_col = F.col(extra).cast("long") if extra else F.lit(1).cast("long")

    def run(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["id", "extra"], kind="stable")
        return pd.DataFrame({"dim": [key[0]], "block": [key[1]], "ids": [part.id.to_numpy("<i8").tobytes()], "extra": [part.extra.to_numpy("<i8").tobytes()], "vecs": [b"".join(part.vec)]})

    dealt = vectors.select("dim", F.pmod(F.xxhash64("id", extra_col), F.lit(blocks)).cast("int").alias("block"), "id", extra_col.alias("extra"), "vec")
    return dealt.groupBy("dim", "block").applyInPandas(run, "dim int, block int, ids binary, extra binary, vecs binary"), blocks


def unpack(row) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    ids = np.frombuffer(row.ids, "<i8")
    return ids, np.frombuffer(row.extra, "<i8"), np.frombuffer(row.vecs, "<f8").reshape(len(ids), -1)
