"""Near-duplicate vectors by randomised-rotation binary codes.

Unit vectors are turned by one random rotation (from a fixed seed) and coded by
the signs of their coordinates, one bit each, with one stored correction factor:
the cosine between the turned vector and its code. For a pair, the product of
one vector's code with the other's turned vector, divided by that factor, is an
unbiased estimate of their cosine. Its error is (sqrt(1 - f^2) / f) times
sqrt(1 - cos^2) times a term that is at most EPSILON / sqrt(dim - 1) with a
probability beyond 1 - 2e-8 (1 - 1e-11 in 64 dimensions), and never more than 1. A pair is recomputed exactly,
in double precision, where this bound lets its cosine reach the threshold; all
other pairs are ruled out by their codes.

Equal vectors are collapsed first. The distinct ones are dealt by a hash into
blocks, and codes, factors and turned vectors of each block are stored once. A pair
of blocks is one task, whatever groups the vectors form: it gets the turned vectors
(single precision) of one and the codes and factors (a bit a dimension) of the other,
and returns the rows that the codes do not rule out. Only those rows' own vectors are
sent on, to be compared exactly; that returns a link count for each vector and a
spanning forest of the links found, never the pairs. All pairs of blocks are looked
at, so work grows with the square of the distinct vectors. Vectors of different
dimension are not compared.

Vectors that are null, empty, zero or hold null or non-finite components link
with nothing. Rows that repeat an id are returned as often as they come, each with
the links of its own vector; component_id is the smallest id of a component, so two
components may carry the same one where an id repeats. Lengths do not overflow: vectors
are scaled by powers of two first. An empty table gives an empty result; other columns
are not read.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch
from .graph import components
from .vectors import BLOCK_ROWS, pack_blocks, read_vectors, scaled, unpack

EPSILON = 6.0
SEED = 20
LOT = 64
_TILE = 1024


@lru_cache(maxsize=4)
def rotation(dim: int, seed: int = SEED) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(seed).normal(size=(dim, dim)))
    return q * np.sign(np.diag(r))


def encode(vecs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(packed sign bits, correction factors, turned unit vectors) of the rows."""
    vecs = scaled(vecs)[0]
    turned = (vecs / np.sqrt(np.einsum("ij,ij->i", vecs, vecs))[:, None]) @ rotation(vecs.shape[1])
    return np.packbits(turned >= 0, axis=1), np.abs(turned).sum(1) / math.sqrt(vecs.shape[1]), turned.astype(np.float32)


def signs(bits: np.ndarray, dim: int) -> np.ndarray:
    return (2 * np.unpackbits(bits, axis=1, count=dim).astype(np.float32) - 1) / np.float32(math.sqrt(dim))


def least_estimate(factor: np.ndarray, dim: int, threshold: float, epsilon: float = EPSILON) -> np.ndarray:
    """The smallest estimate that a cosine >= threshold can have."""
    f = np.clip(factor, 1e-6, 1.0)
    spread = min(1.0, epsilon / math.sqrt(max(1, dim - 1)))
    return threshold - np.sqrt(1 - f * f) / f * math.sqrt(max(0.0, 1 - threshold * threshold)) * spread - 1e-4


def surviving_rows(turned: np.ndarray, bits: np.ndarray, factor: np.ndarray, threshold: float, same: bool, epsilon: float = EPSILON) -> tuple[np.ndarray, np.ndarray]:
    """Which rows on each side belong to a pair that the codes do not rule out. same: both
    sides are one block, and each pair is looked at once."""
    dim = turned.shape[1]
    left, right = np.zeros(len(turned), bool), np.zeros(len(bits), bool)
    for start in range(0, len(bits), _TILE):
        code = signs(bits[start : start + _TILE], dim)
        f = factor[start : start + _TILE]
        floor = (least_estimate(f, dim, threshold, epsilon) * f).astype(np.float32)[:, None]  # estimate >= least, before the division
        for other in range(start if same else 0, len(turned), _TILE):
            open_ = code @ turned[other : other + _TILE].T >= floor
            if same:
                open_ &= np.arange(start, start + len(code))[:, None] < np.arange(other, other + open_.shape[1])[None]
            right[start : start + len(code)] |= open_.any(1)
            left[other : other + open_.shape[1]] |= open_.any(0)
    return left, right


def exact_links(a: np.ndarray, b: np.ndarray, threshold: float):
    """Row numbers (i, j) with cosine >= threshold, in double precision."""
    a, b = scaled(a)[0], scaled(b)[0]
    size_a, size_b = (np.sqrt(np.einsum("ij,ij->i", v, v)) for v in (a, b))
    for start in range(0, len(a), _TILE):
        unit = a[start : start + _TILE] / size_a[start : start + _TILE, None]
        for other in range(0, len(b), _TILE):
            i, j = np.nonzero(unit @ (b[other : other + _TILE] / size_b[other : other + _TILE, None]).T >= threshold - 1e-9)
            i, j = i + start, j + other
            for at in range(0, len(i), 200_000):
                x, y = i[at : at + 200_000], j[at : at + 200_000]
                hit = np.einsum("ij,ij->i", a[x], b[y]) / (size_a[x] * size_b[y]) >= threshold
                yield x[hit], y[hit]


def _forest(label: np.ndarray, x: np.ndarray, y: np.ndarray) -> None:
    """Lowers labels along links until each tree agrees on its least."""
    while True:
        low = np.minimum(label[x], label[y])
        if (label[x] == low).all() and (label[y] == low).all():
            return
        np.minimum.at(label, x, low)
        np.minimum.at(label, y, low)
        label[:] = label[label]


def _store(part: pd.DataFrame) -> pd.DataFrame:
    """Codes, factors and turned vectors of packed blocks."""
    made = [[x.tobytes() for x in encode(unpack(row)[2])] for row in part.itertuples()]
    return part.assign(**{name: [m[i] for m in made] for i, name in enumerate(("bits", "factor", "turned"))})


def _rule_out(threshold: float, epsilon: float):
    def run(part: pd.DataFrame) -> pd.DataFrame:
        sides = {r.side: r for r in part.itertuples()}
        turned = np.frombuffer(sides[0].payload, np.float32).reshape(-1, int(part.dim.iloc[0]))
        factor = np.frombuffer(sides[1].factor, np.float64)
        bits = np.frombuffer(sides[1].payload, np.uint8).reshape(len(factor), -1)
        row = sides[0]
        left, right = surviving_rows(turned, bits, factor, threshold, row.low == row.high, epsilon)
        if row.low == row.high:
            left = right = left | right
        packed = [np.flatnonzero(side).astype("<i4").tobytes() for side in (left, right)]
        out = pd.DataFrame({"dim": row.dim, "low": row.low, "high": row.high, "side": np.array([0, 1], "int32"), "block": [row.low, row.high], "rows": packed})
        return out[: 1 if row.low == row.high else 2] if left.any() else out[:0]

    return run


def _slices(needs: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
    """The rows that each pair of blocks still needs of one block."""
    ids, times, vecs = unpack(next(block.itertuples()))
    out = []
    for need in needs.itertuples():
        at = np.frombuffer(need.rows, "<i4")
        out.append((need.dim, need.low, need.high, need.side, ids[at].tobytes(), times[at].tobytes(), vecs[at].tobytes()))
    return pd.DataFrame(out, columns=["dim", "low", "high", "side", "ids", "extra", "vecs"])


def _compare(threshold: float):
    def run(part: pd.DataFrame) -> pd.DataFrame:
        rows = list(part.sort_values("side").itertuples())
        same = len(rows) == 1
        (ids_a, times_a, vecs_a), (ids_b, times_b, vecs_b) = unpack(rows[0]), unpack(rows[-1])
        shift = 0 if same else len(ids_a)
        ids = ids_a if same else np.concatenate([ids_a, ids_b])
        links, label = np.zeros(len(ids), np.int64), np.arange(len(ids))
        order = np.argsort(ids, kind="stable")  # labels are places in order of id, so the least is the smallest id
        place = np.empty(len(ids), np.int64)
        place[order] = np.arange(len(ids))
        for x, y in exact_links(vecs_a, vecs_b, threshold):
            if same:
                x, y = x[x < y], y[x < y]
            np.add.at(links, x, times_b[y])
            np.add.at(links, y + shift, times_a[x])
            _forest(label, place[x], place[y + shift])
        root = ids[order][label[place]]
        some = links > 0
        return pd.DataFrame({"id": ids[some], "links": links[some], "root": root[some]})

    return run


def near_vectors(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = 0.9, block_rows: int = BLOCK_ROWS, epsilon: float = EPSILON) -> DataFrame:
    """(id, n_links, component_id, kept) of every row; see the module's text."""
    scratch = Scratch(rows.sparkSession, "vectors")
    vectors = scratch.save(read_vectors(rows, id_col, vector_col))
    key = ["dim", "key_high", "key_low"]
    # classes of equal vectors are numbered as they are written; no two share a number,
    # whatever their ids
    distinct = vectors.where("valid").groupBy(*key).agg(F.min("id").alias("least"), F.count("*").alias("times"), F.first("vec").alias("vec"))
    distinct = scratch.save(distinct.withColumn("id", F.monotonically_increasing_id()))
    packed, blocks = pack_blocks(distinct, block_rows, "times")
    kept = "dim int, block int, ids binary, extra binary, vecs binary"
    stored = scratch.save(packed.mapInPandas(lambda parts: map(_store, parts), f"{kept}, bits binary, factor binary, turned binary"))
    pair = ["dim", "low", "high"]
    last, none = F.lit(blocks - 1), F.lit(None).cast("binary")
    queries = stored.select("dim", F.col("block").alias("low"), F.explode(F.sequence(F.col("block"), last)).alias("high"), F.lit(0).alias("side"), F.col("turned").alias("payload"), none.alias("factor"))
    codes = stored.select("dim", F.explode(F.sequence(F.lit(0), F.col("block"))).alias("low"), F.col("block").alias("high"), F.lit(1).alias("side"), F.col("bits").alias("payload"), "factor")
    # a block that has no vectors of a dimension has no row, so a pair may lack a side
    both = queries.unionByName(codes).join(stored.select("dim", F.col("block").alias("low")), ["dim", "low"], "left_semi").join(stored.select("dim", F.col("block").alias("high")), ["dim", "high"], "left_semi")
    needs = scratch.save(both.groupBy(*pair).applyInPandas(_rule_out(threshold, epsilon), "dim int, low int, high int, side int, block int, rows binary"))
    # a task slices one block for LOT others at most
    needs = needs.withColumn("lot", F.floor((F.col("low") + F.col("high") - F.col("block")) / LOT).cast("int"))
    key_of = ["dim", "block", "lot"]
    wanted = needs.select(*key_of).distinct().join(stored.select("dim", "block", "ids", "extra", "vecs"), ["dim", "block"])
    wanted = wanted.select(*(F.col(c).alias(f"of_{c}") for c in key_of), "ids", "extra", "vecs")
    sent = needs.groupBy(*key_of).cogroup(wanted.groupBy(*(f"of_{c}" for c in key_of))).applyInPandas(_slices, "dim int, low int, high int, side int, ids binary, extra binary, vecs binary")
    found = scratch.save(sent.groupBy(*pair).applyInPandas(_compare(threshold), "id long, links long, root long"))
    parts = components(found.where("id != root").select(F.col("id").alias("a"), F.col("root").alias("b")), scratch)
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    classes = distinct.select(*key, "id", "least", "times").join(links, "id", "left").join(parts.withColumnRenamed("node", "id"), "id", "left")
    classes = classes.select(*key, "least", (F.coalesce("links", F.lit(0)) + F.col("times") - 1).alias("n_links"), F.coalesce("component", "id").alias("component"))
    classes = scratch.save(classes)
    smallest = classes.groupBy("component").agg(F.min("least").alias("component_id"))
    classes = classes.join(smallest, "component").select(*key, "n_links", "component_id")
    own = [vectors[k] == classes[k] for k in key]
    out = vectors.where("valid").join(classes, own).select("id", "n_links", "component_id")
    lone = vectors.where("not valid").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return out.unionByName(lone).select(F.col("id").alias(id_col), "n_links", "component_id", (F.col("id") == F.col("component_id")).alias("kept"))
