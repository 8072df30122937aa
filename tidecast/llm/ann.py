"""Nearest neighbours by a block matrix join with int8 tiles.

Queries and candidates are dealt into blocks by a hash of their ids, and each
pair of a query block and a candidate block is one task. Vectors are quantised
to int8 with a scale of their own, and the exact length of what rounding left is
kept. A tile's product of int8 codes gives each squared distance up to an error
that these lengths bound on both sides. A candidate survives if its lower bound
does not exceed the k-th smallest upper bound of its query; survivors are
recomputed in double precision and kept in a heap of k. Heaps of all blocks are
merged along rows sorted by query, with k entries held at a time.

The result is exact: the bounds hold for every pair. Vectors that are null,
empty, zero or hold null or non-finite components take no part, and vectors of
different dimension are not compared. Ties go to the smaller id. Rows that repeat an
id are queries and candidates of their own; only a query's own row is none for it. An
empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch
from .vectors import BLOCK_ROWS, pack_blocks, read_vectors, unpack

_DEPTH = 1024  # 127 * 127 * 1024 < 2**24: float32 sums of int8 products stay exact
_TILE = 512


class Int8Block:
    """Codes, scales and lengths of a block's rows. unit is a power of two that all of
    a tile's rows are divided by, so that squares stay finite."""

    def __init__(self, vecs: np.ndarray, unit: float = 1.0):
        self.vecs = vecs
        vecs = vecs / unit
        top = np.abs(vecs).max(1, keepdims=True) if vecs.size else np.ones((len(vecs), 1))
        self.scale = np.maximum(top, 1e-290) / 127.0
        self.codes = np.rint(vecs / self.scale).astype(np.int8)
        rest = vecs - self.scale * self.codes
        self.square = np.einsum("ij,ij->i", vecs, vecs)
        self.length = np.sqrt(self.square)
        self.rest = np.sqrt(np.einsum("ij,ij->i", rest, rest)) * (1 + 1e-9)


def tile_bounds(q: Int8Block, c: Int8Block, rows: slice) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of squared distances of some queries to all candidates."""
    product = np.zeros((len(q.vecs[rows]), len(c.vecs)))
    for at in range(0, q.vecs.shape[1], _DEPTH):
        product += q.codes[rows, at : at + _DEPTH].astype(np.float32) @ c.codes[:, at : at + _DEPTH].astype(np.float32).T
    product *= q.scale[rows] * c.scale.T
    middle = q.square[rows][:, None] + c.square[None] - 2 * product
    slack = 2 * (q.rest[rows][:, None] * (c.length + c.rest)[None] + q.length[rows][:, None] * c.rest[None])
    slack += 1e-12 * (q.square[rows][:, None] + c.square[None]) + 1e-290
    return middle - slack, middle + slack


def _distances(rows: np.ndarray, to: np.ndarray) -> np.ndarray:
    """Euclidean distances in double precision, also of very large or small components."""
    with np.errstate(over="ignore"):
        gap = rows - to
        plain = np.sqrt(np.einsum("ij,ij->i", gap, gap))
    odd = ~np.isfinite(plain) | (plain < 1e-140)
    if odd.any():
        top = np.maximum(np.abs(gap[odd]).max(1, keepdims=True), np.finfo(float).tiny)
        with np.errstate(invalid="ignore", over="ignore"):
            plain[odd] = np.where(np.isfinite(top[:, 0]), top[:, 0] * np.sqrt(((gap[odd] / top) ** 2).sum(1)), np.inf)
    return plain


def block_nearest(q: Int8Block, q_rows: np.ndarray, c: Int8Block, c_ids: np.ndarray, c_rows: np.ndarray, k: int) -> Iterator[tuple[int, list[tuple[float, int]]]]:
    """(place of a query, its k nearest in the block as (distance, id))."""
    for start in range(0, len(q_rows), _TILE):
        low, high = tile_bounds(q, c, slice(start, start + _TILE))
        own = q_rows[start : start + _TILE, None] == c_rows[None]
        low[own], high[own] = np.inf, np.inf
        kth = np.partition(high, k - 1, axis=1)[:, k - 1] if high.shape[1] >= k else np.full(len(high), np.inf)
        for i in range(len(low)):
            near = np.flatnonzero((low[i] <= kth[i]) & ~own[i])
            exact = _distances(c.vecs[near], q.vecs[start + i])
            yield start + i, heapq.nsmallest(k, zip(exact.tolist(), c_ids[near].tolist()))


def nearest(rows: DataFrame, is_query: Column, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding", block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(query_id, rank from 1, id, score): the k nearest of each query by Euclidean
    distance; is_query is a condition on the id column."""
    scratch = Scratch(rows.sparkSession, "nearest")
    vectors = read_vectors(rows, id_col, vector_col).where("valid").withColumnRenamed("id", id_col).withColumn("query", is_query).withColumnRenamed(id_col, "id")
    vectors = scratch.save(vectors.withColumn("row", F.monotonically_increasing_id()))  # rows keep their number as written
    queries, query_blocks = pack_blocks(vectors.where("query"), block_rows, "row")
    candidates, blocks = pack_blocks(vectors, block_rows, "row")
    each = lambda df, n, own, other, side: df.select("dim", F.col("block").alias(own), F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias(other), F.lit(side).alias("side"), "ids", "extra", "vecs")
    dealt = each(scratch.save(queries), blocks, "left", "right", 0).unionByName(each(scratch.save(candidates), query_blocks, "right", "left", 1))

    def run(part: pd.DataFrame) -> pd.DataFrame:
        sides = {r.side: r for r in part.itertuples()}
        out: list[tuple] = []
        if len(sides) == 2:
            (q_ids, q_rows, q), (c_ids, c_rows, c) = unpack(sides[0]), unpack(sides[1])
            unit = 2.0 ** max(-1000, min(1000, int(np.frexp(max(np.abs(q).max(), np.abs(c).max()))[1])))
            for at, best in block_nearest(Int8Block(q, unit), q_rows, Int8Block(c, unit), c_ids, c_rows, k):
                out += [(int(q_rows[at]), int(q_ids[at]), i, d) for d, i in best]
        return pd.DataFrame(out, columns=["row", "query_id", "id", "score"]).astype({"row": "int64", "query_id": "int64", "id": "int64", "score": "float64"})

    found = dealt.groupBy("dim", "left", "right").applyInPandas(run, "row long, query_id long, id long, score double")

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, heap, out = None, [], []

        def close():
            out.extend((now[1], rank, -i, -d) for rank, (d, i) in enumerate(sorted(heap, reverse=True), 1))

        def flush():
            columns = list(zip(*out)) or [(), (), (), ()]
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.float64())
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, kinds)], ["query_id", "rank", "id", "score"])

        for batch in batches:
            for row, query, i, d in zip(*(batch.column(x).to_pylist() for x in range(4))):
                if now is None or row != now[0]:
                    if heap:
                        close()
                    now, heap = (row, query), []
                if len(heap) < k:
                    heapq.heappush(heap, (-d, -i))
                else:
                    heapq.heappushpop(heap, (-d, -i))
            if len(out) > 10_000:
                yield flush()
                out.clear()
        if heap:
            close()
        if out:
            yield flush()

    merged = found.repartition("row").sortWithinPartitions("row").mapInArrow(merge, "query_id long, rank int, id long, score double")
    return merged.withColumnRenamed("id", id_col)
