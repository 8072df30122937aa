"""Language identification with bit-sliced Bloom filters.

One table of words holds a bit for each language in every slot: the Bloom
filters of all languages, sliced by bit. The AND of an n-gram's slots is the
mask of all languages whose filter holds the n-gram. A text's masks are counted
into one number of hits for each language, false positives that the filter's
fill predicts are taken off, and the language with most corrected hits wins.

N-grams are 1 to 4 letters long with word ends marked, lower case. Each
language's filter is learned from a sample of about SAMPLE_DOCS documents (taken by
a hash of the id with a share that expects that number, equally from each language)
and holds the n-grams found in at least MIN_SHARE of them. Should these be more than
MAX_GRAMS, it holds those found in most documents, and of the last ones, which are
found in equally many, a share by a hash that expects to make up MAX_GRAMS.

Null texts and texts without a letter (a character of one of Unicode's letter
categories) give `und` with score 0. Ties go to the language that sorts first. With
no learned language every text gives `und`. Repeated rows are predicted as often as
they come, a text costs time in proportion to its length, an empty table gives an
empty result, and other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, batch_rows

SAMPLE_DOCS = 6_000
MIN_SHARE = 0.02
MAX_GRAMS = 20_000
SLOTS = 1 << 18
PROBES = 3
SIZES = (1, 2, 3, 4)
WORD = 64
PART = 1 << 17
_MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)


def _letters() -> np.ndarray:
    """Code point -> lower-case code point of a letter, 0 for anything else (BMP
    and beyond it one shared class)."""
    table = np.zeros(1 << 16, np.uint32)
    for c in range(1 << 16):
        if not 0xD800 <= c < 0xE000 and (x := chr(c)).isalpha():
            table[c] = ord(low) if len(low := x.lower()) == 1 else c
    return table


_TABLE = _letters()


def _codes(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "replace"), "<u4")
    return np.where(points < (1 << 16), _TABLE[np.minimum(points, (1 << 16) - 1)], points).astype(np.uint64)


def gram_parts(text: str, part: int = PART) -> Iterator[np.ndarray]:
    """64-bit hashes of all n-grams of a text, those that begin in `part` characters at a
    time; a gram never spans two words."""
    end = np.zeros(1, np.uint64)  # a word end stands before and after the text
    for at in range(0, len(text) + 2, part):
        stop = at + part + SIZES[-1] - 1
        codes = np.concatenate([end[: at == 0], _codes(text[max(0, at - 1) : stop - 1]), end[: stop >= len(text) + 2]])
        inside, found, mixed = codes != 0, [], codes + np.uint64(1)
        for n in SIZES:
            # the gram of n characters from i on; its first and last may be a word end
            m = len(codes) - n + 1
            if m <= 0:
                break
            if n > 1:
                mixed = mixed[:m] * np.uint64(0x100000001B3) + codes[n - 1 :] + np.uint64(n)
            ok = inside[:m].copy() if n == 1 else np.ones(m, bool)
            for k in range(1, n - 1):
                ok &= inside[k : k + m]
            if n == 2:
                ok &= inside[:m] | inside[1 : m + 1]
            ok[part:] = False
            found.append(mixed[ok] * _MULTIPLIERS[0])
        yield np.concatenate(found)


def gram_hashes(text: str) -> np.ndarray:
    return np.concatenate(list(gram_parts(text)))


@dataclass
class BitSlicedFilter:
    languages: list[str]
    slots: np.ndarray  # one mask of languages for each slot; beyond WORD languages a row of masks
    false_rate: np.ndarray  # of each language

    @classmethod
    def build(cls, grams: dict[str, np.ndarray], size: int = SLOTS) -> BitSlicedFilter:
        languages = sorted(grams)
        slots = np.zeros((size, max(1, -(-len(languages) // WORD))), np.uint64)
        for bit, lang in enumerate(languages):
            for at in cls.places(grams[lang], size):
                np.bitwise_or.at(slots[:, bit // WORD], at, np.uint64(1 << bit % WORD))
        fill = np.array([np.count_nonzero(slots[:, b // WORD] & np.uint64(1 << b % WORD)) / size for b in range(len(languages))])
        kind = np.uint8 if len(languages) <= 8 else np.uint64
        return cls(languages, (slots if len(languages) > WORD else slots[:, 0]).astype(kind), fill**PROBES)

    @staticmethod
    def places(hashes: np.ndarray, size: int) -> list[np.ndarray]:
        shift = np.uint64(64 - (size.bit_length() - 1))
        return [(((hashes ^ (hashes >> np.uint64(29))) * m) >> shift).astype(np.int64) for m in _MULTIPLIERS[1 : 1 + PROBES]]

    def masks(self, hashes: np.ndarray) -> np.ndarray:
        first, *rest = self.places(hashes, len(self.slots))
        out = self.slots[first]
        for at in rest:
            out = out & self.slots[at]
        return out

    def counts(self, masks: np.ndarray) -> np.ndarray:
        """Hits of each language, by popcounts over the bytes of the masks."""
        raw = np.ascontiguousarray(masks).view(np.uint8).reshape(len(masks), self.slots[:1].nbytes)
        bits = (np.arange(256)[:, None] >> np.arange(8)) & 1
        per_byte = [np.bincount(raw[:, k], minlength=256) @ bits for k in range(raw.shape[1])]
        return np.concatenate(per_byte)[: len(self.languages)]

    def predict(self, text: str | None) -> tuple[str, float]:
        if not text or not self.languages or not any(map(str.isalpha, text)):
            return "und", 0.0
        counts, n = np.zeros(len(self.languages)), 0
        for part in gram_parts(text):
            counts += self.counts(self.masks(part))
            n += len(part)
        hits = np.clip((counts / max(1, n) - self.false_rate) / np.maximum(1e-9, 1 - self.false_rate), 0, None)
        best = int(np.argmax(hits))
        second = float(np.max(np.delete(hits, best))) if len(hits) > 1 else 0.0
        return self.languages[best], float(np.clip(hits[best] / max(1e-12, hits[best] + second), 0, 1))


def learn(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, size: int = SLOTS) -> BitSlicedFilter:
    """Filters from rows (doc_id, text, lang) with a language. The driver gets
    about MAX_GRAMS n-grams of each language, and a row for each number of documents."""
    rows = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("doc_id", "text", "lang")
    totals = sorted(rows.groupBy("lang").count().collect())
    if not totals:
        return BitSlicedFilter.build({}, size)
    each, span = max(1, sample_docs // len(totals)), 1 << 30
    lot = F.pmod(F.xxhash64("doc_id", F.lit("langid")), F.lit(span))
    share = F.coalesce(*(F.when(F.col("lang") == lang, F.lit(int(span * min(1.0, each / n)))) for lang, n in totals))
    place = {lang: i for i, (lang, _) in enumerate(totals)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in batch_rows(whole):
                by = {}
                for text, lang in zip(batch.column(0), batch.column(1).to_pylist()):
                    by.setdefault(lang, []).append(np.unique(np.concatenate([np.unique(p) for p in gram_parts(text.as_py())])))
                for lang, parts in by.items():
                    grams, n = np.unique(np.concatenate(parts), return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array([place[lang]] * len(grams), pa.int32()), pa.array(grams.view(np.int64)), pa.array(n, pa.int64())], ["place", "gram", "n"])

    sample = rows.where(lot < share).select("text", "lang")
    counted = sample.mapInArrow(run, "place int, gram long, n long").groupBy("place", "gram").agg(F.sum("n").alias("n"))
    least = F.coalesce(*(F.when(F.col("place") == place[lang], F.lit(MIN_SHARE * min(each, n))) for lang, n in totals))
    kept = Scratch(docs.sparkSession, "grams").save(counted.where(F.col("n") >= least))
    # how many n-grams stand in each number of documents decides where a language's list ends:
    # at one number, of which a share goes in by a hash
    share, held = {}, {}
    for r in kept.groupBy("place", "n").agg(F.count("*").alias("grams")).orderBy("place", F.desc("n")).collect():
        room = MAX_GRAMS - held.get(r.place, 0)
        if room > 0:
            share[r.place] = (r.n, min(1.0, room / r.grams))
        held[r.place] = held.get(r.place, 0) + r.grams
    grams = {}
    drawn = F.pmod(F.xxhash64("gram"), F.lit(span))
    enough = F.coalesce(*(F.when((F.col("place") == i) & ((F.col("n") > n) | ((F.col("n") == n) & (drawn < int(span * part)))), True) for i, (n, part) in share.items()), F.lit(False))
    rows_of = kept.where(enough).select("place", "gram").toPandas()
    for lang, i in place.items():
        grams[lang] = rows_of.gram[rows_of.place == i].to_numpy(np.int64).view(np.uint64)
    return BitSlicedFilter.build(grams, size)


def identify(docs: DataFrame, model: BitSlicedFilter) -> DataFrame:
    """(doc_id, lang_pred, score) of every row's whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [shared.value.predict(x.as_py()) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64())], ["doc_id", "lang_pred", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, lang_pred string, score double")
