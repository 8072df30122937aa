"""Quality by nearest-neighbour voting over latent-semantic vectors.

The terms of a text are trigrams of character classes (letter case, digits,
spaces, line ends and kinds of punctuation), counted over the whole text, and
graded measures of repetition and of word and line shape. Their damped, idf
weighted counts are projected by a truncated SVD onto DIMENSIONS latent axes.
The latent vectors of labelled documents are broadcast; every document's exact
cosines with all of them come from blocked matrix products, and its NEIGHBOURS
nearest vote with weights that grow with their similarity.

Labels come from at most TRAIN_DOCS labelled rows, taken by a hash of the id,
as evenly from both labels as these allow; votes are reweighted to the labels'
shares in all labelled rows. The broadcast therefore holds at most
TRAIN_DOCS x DIMENSIONS floats and the projection. Only the text is an input.
Null and empty texts are scored as a text without terms: the share of label 1.
With no labels every score is 0.5. Similarities count to six places; ties between
neighbours go to the earlier one in the order of the sample (by hash, then id).
Rows that repeat are scored as often as they come, a label that repeats counts
once (the higher one). Very long texts cost time in proportion to their length.
An empty table gives an empty result; columns other than doc_id and text are not
read but where asked for.
"""

from __future__ import annotations

import operator
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import carried

TRAIN_DOCS = 6_000
DIMENSIONS = 48
NEIGHBOURS = 25
SHARPNESS = 12.0
BLOCK = 512
_KINDS = ("\n", " \t\r", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", ".", ",", "!?", "|<>{}[]\\/", "%$#&*^~=+@_`", ";:'\"()-")


def _classes() -> np.ndarray:
    table = np.full(256, 2, np.uint8)  # bytes of letters beyond ASCII count as lower case
    table[:128] = len(_KINDS)
    for kind, chars in enumerate(_KINDS):
        table[[ord(c) for c in chars]] = kind
    return table


_TABLE = _classes()
_N = len(_KINDS) + 1
_GRADES = 16
_MEASURES = 7
TERMS = _N**3 + _GRADES * _MEASURES


def _grade(out: np.ndarray, which: int, share: float, weight: float) -> None:
    """A share of 0..1 as weight on the two nearest of _GRADES steps."""
    x = min(max(share, 0.0), 1.0) * (_GRADES - 1)
    low = min(int(x), _GRADES - 2)
    at = _N**3 + which * _GRADES + low
    out[at] += weight * (1 - (x - low))
    out[at + 1] += weight * (x - low)


def terms(text: str | None) -> np.ndarray:
    """Damped term counts of the whole text."""
    raw = _TABLE[np.frombuffer((text or "").encode("utf-8", "replace"), np.uint8)].astype(np.int32)
    out = np.zeros(TERMS, np.float32)
    if len(raw) < 3:
        return out
    codes = (raw[:-2] * _N + raw[1:-1]) * _N + raw[2:]
    counts = np.bincount(codes, minlength=_N**3)
    out[: _N**3] = np.sqrt(counts / len(codes))
    words = text.split()
    n = max(1, len(words))
    same = sum(map(operator.eq, words, words[1:]))
    ones = np.bincount(raw, minlength=_N) / len(raw)
    lines = text.count("\n") + 1
    for which, share in enumerate((np.sqrt(same / n), 1 - len(set(words)) / n, np.sqrt(ones[3]), np.sqrt(ones[7:11].sum()), len(raw) / n / 16, np.log1p(n) / 10, np.log1p(n / lines) / 8)):
        _grade(out, which, float(share), _WEIGHTS[which])
    return out


def pack_terms(row: np.ndarray) -> bytes:
    """Places (16 bit) and values (32 bit) of the terms that a text has."""
    at = np.flatnonzero(row)
    return at.astype("<u2").tobytes() + row[at].astype("<f4").tobytes()


def unpack_terms(rows: list[bytes]) -> np.ndarray:
    out = np.zeros((len(rows), TERMS), np.float32)
    for i, raw in enumerate(rows):
        n = len(raw) // 6
        out[i, np.frombuffer(raw, "<u2", n)] = np.frombuffer(raw, "<f4", n, 2 * n)
    return out


# How far each measure counts beside the trigrams, whose squares sum to 1.
_WEIGHTS = (1.2, 0.8, 0.5, 0.8, 0.3, 0.3, 0.2)


@dataclass
class LatentVoter:
    weights: np.ndarray  # idf of each term
    axes: np.ndarray  # terms x dimensions
    vectors: np.ndarray  # unit rows of the labelled documents
    votes: np.ndarray  # label of each
    balance: np.ndarray  # weight of each
    prior: float

    @classmethod
    def fit(cls, packed: list[bytes], labels: np.ndarray, prior: float, dimensions: int = DIMENSIONS) -> LatentVoter:
        """From the packed terms of labelled texts, which are opened BLOCK rows at a time."""
        blocks = lambda: (unpack_terms(packed[at : at + BLOCK]) for at in range(0, len(packed), BLOCK))
        seen = sum(((b > 0).sum(0) for b in blocks()), np.zeros(TERMS))
        weights = (np.log((1 + len(packed)) / (1 + seen)) + 0.3).astype(np.float32)
        moments = np.zeros((TERMS, TERMS))
        for b in blocks():
            b *= weights
            moments += b.T @ b
        axes = np.linalg.eigh(moments)[1] if packed else np.zeros((TERMS, 1))
        axes = np.ascontiguousarray(axes[:, ::-1][:, :dimensions].astype(np.float32))
        vectors = np.concatenate([np.zeros((0, axes.shape[1]), np.float32), *(cls._unit((b * weights) @ axes) for b in blocks())])
        share = labels.mean() if len(labels) else 0.5
        balance = np.where(labels == 1, prior / max(share, 1e-9), (1 - prior) / max(1 - share, 1e-9)).astype(np.float32)
        return cls(weights, axes, vectors, labels.astype(np.float32), balance, prior)

    @staticmethod
    def _unit(x: np.ndarray) -> np.ndarray:
        return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)

    def scores(self, counts: np.ndarray) -> np.ndarray:
        out = np.full(len(counts), self.prior)
        if not len(self.vectors):
            return out
        own = self._unit((counts * self.weights) @ self.axes)
        alike = np.round(own @ self.vectors.T, 6)  # so that equal vectors tie
        k = min(NEIGHBOURS, alike.shape[1])
        least = np.partition(alike, -k, axis=1)[:, -k]
        for i in np.flatnonzero(counts.any(1)):
            row = alike[i]
            closer, equal = np.flatnonzero(row > least[i]), np.flatnonzero(row == least[i])
            near = np.concatenate([closer, equal[: k - len(closer)]])
            weight = np.exp(SHARPNESS * (row[near] - row[near].max())) * self.balance[near]
            out[i] = float((weight * self.votes[near]).sum() / weight.sum())
        return np.clip(out, 0.0, 1.0)


def learn(docs: DataFrame, labels: DataFrame, train_docs: int = TRAIN_DOCS) -> LatentVoter:
    """A voter from docs (doc_id, text) and labels (doc_id, quality 0 or 1); other
    labels and nulls are no labels. The driver gets at most train_docs term rows."""
    known = labels.select("doc_id", F.col("quality").cast("int").alias("quality")).where(F.col("quality").isin(0, 1)).groupBy("doc_id").agg(F.max("quality").alias("quality"))
    sizes = {q: n for q, n in known.groupBy("quality").count().collect()}
    total = sum(sizes.values())
    if not total:
        return LatentVoter.fit([], np.zeros(0), 0.5)
    half, span = train_docs // 2, 1 << 30
    want = {q: min(sizes.get(q, 0), max(half, train_docs - sizes.get(1 - q, 0))) for q in (0, 1)}
    lot = F.pmod(F.xxhash64("doc_id", F.lit("quality")), F.lit(span))
    least = F.when(F.col("quality") == 1, int(span * want[1] / max(1, sizes.get(1, 0)))).otherwise(int(span * want[0] / max(1, sizes.get(0, 0))))
    chosen = known.where(lot < least)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [pack_terms(terms(x.as_py())) for x in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(rows, pa.binary())], ["doc_id", "quality", "terms"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    sampled = docs.select("doc_id", "text").where(F.col("text") != "").join(F.broadcast(chosen), "doc_id").select("doc_id", "quality", "text")
    found = sampled.mapInArrow(run, f"doc_id {kind}, quality int, terms binary").orderBy(F.xxhash64("doc_id", F.lit("quality")), "doc_id").limit(train_docs).collect()
    return LatentVoter.fit([bytes(r.terms) for r in found], np.array([r.quality for r in found]), sizes.get(1, 0) / total)


def score(docs: DataFrame, model: LatentVoter, extra: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, score of every row's whole text, and the extra columns as they are; an
    extra column named like one of the two gives way to it."""
    extra = carried(extra, "doc_id", "score")
    shared = docs.sparkSession.sparkContext.broadcast(model)
    others = tuple(c for c in extra if c != "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                block = batch.slice(at, BLOCK)
                got = shared.value.scores(np.array([terms(x.as_py()) for x in block.column(1)]).reshape(block.num_rows, TERMS))
                carried = [block.column(c) for c in extra]
                yield pa.RecordBatch.from_arrays([block.column(0), pa.array(got, pa.float64()), *carried], ["doc_id", "score", *extra])

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = ", ".join([f"doc_id {kind}", "score double", *(f"{c} {docs.schema[c].dataType.simpleString()}" for c in extra)])
    return docs.select("doc_id", "text", *others).mapInArrow(run, schema)
