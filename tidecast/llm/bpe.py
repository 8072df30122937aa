"""Byte-level BPE: a contiguous rank array for each short word.

A word starts as its bytes. One list holds the ids of the parts (the part
boundaries), a second list of the same order the merge ranks of adjacent parts.
The smallest rank is found by a scan, its boundary is deleted from both lists,
and the ranks to its left and right are looked up anew. Words of more than
SHORT parts take a heap over linked parts instead, as a scan for each merge
would cost the square of the length. Results of words are kept in a cache of
bounded size with two generations.

Nulls and empty texts give no ids. Strings of special tokens inside a text
become their single id, as in the tokenizers library.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import sys
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

SHORT = 96
CACHE_WORDS = 200_000
NO_RANK = 1 << 30
# Fixed value: the public pre-tokenizer pattern of byte-level BPE vocabularies.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_alphabet() -> dict[int, str]:
    """The printable character that stands for each byte in vocabulary files:
    printable Latin-1 characters for themselves, the rest from code point 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return {b: chr(b if b in plain else next(spare)) for b in range(256)}


class _Words(dict):
    """word -> packed ids; the older generation goes when the newer is full."""

    def __init__(self, make, limit: int):
        self.make, self.limit, self.old = make, limit, {}

    def __missing__(self, word):
        got = self.old.get(word)
        if got is None:
            got = self.make(word)
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
        if len(word) <= SHORT:
            self[word] = got
        return got


class RankArrayBPE:
    def __init__(self, path: str, cache_words: int = CACHE_WORDS):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, alphabet = spec["model"], byte_alphabet()
        back = {c: b for b, c in alphabet.items()}
        vocab = model["vocab"]
        self.table: list[bytes] = [b""] * (1 + max([*vocab.values(), *(t["id"] for t in spec["added_tokens"])]))
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        for word, i in vocab.items():
            self.table[i] = word.encode() if word in self.special else bytes(back[c] for c in word)
        for word, i in self.special.items():
            self.table[i] = word.encode()
        self.first = [vocab[alphabet[b]] for b in range(256)]
        self.ranks: dict[int, int] = {}
        self.merged: list[int] = []
        for rank, pair in enumerate(model["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.ranks[vocab[a] << 32 | vocab[b]] = rank
            self.merged.append(vocab[a + b])
        self.start = [self.ranks.get(a << 32 | b, NO_RANK) for a in self.first for b in self.first]
        self.find = regex.compile(PATTERN).findall
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.words = _Words(self._pack, cache_words)

    def _pack(self, word: str) -> bytes:
        raw = word.encode("utf-8", "surrogatepass")
        out = array("I", (self._scan if len(raw) <= SHORT else self._heap)(raw))
        if sys.byteorder == "big":
            out.byteswap()
        return out.tobytes()

    def _scan(self, raw: bytes) -> list[int]:
        get, merged, start = self.ranks.get, self.merged, self.start
        parts = [*map(self.first.__getitem__, raw)]
        ranks = [start[a << 8 | b] for a, b in zip(raw, raw[1:])]
        while ranks:
            low = min(ranks)
            if low == NO_RANK:
                break
            i = ranks.index(low)
            parts[i] = merged[low]
            del parts[i + 1], ranks[i]
            if i < len(ranks):
                ranks[i] = get(parts[i] << 32 | parts[i + 1], NO_RANK)
            if i:
                ranks[i - 1] = get(parts[i - 1] << 32 | parts[i], NO_RANK)
        return parts

    def _heap(self, raw: bytes) -> list[int]:
        parts = [*map(self.first.__getitem__, raw)]
        n, get = len(parts), self.ranks.get
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, parts[i], parts[i + 1]) for i in range(n - 1) if (r := get(parts[i] << 32 | parts[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            rank, i, a, b = heapq.heappop(heap)
            j = after[i]
            if parts[i] != a or j >= n or parts[j] != b:
                continue
            parts[i], parts[j], after[i] = self.merged[rank], -1, after[j]
            if after[i] < n:
                before[after[i]] = i
            for x, y in ((before[i], i), (i, after[i])):
                if x >= 0 and y < n and (r := get(parts[x] << 32 | parts[y])) is not None:
                    heapq.heappush(heap, (r, x, parts[x], parts[y]))
        return [p for p in parts if p >= 0]

    def encode_packed(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit integers."""
        if self.cut and any(s in text for s in self.special):
            out = []
            for piece in self.cut.split(text):
                if piece in self.special:
                    out.append(np.uint32(self.special[piece]).astype("<u4").tobytes())
                elif piece:
                    out.append(b"".join(map(self.words.__getitem__, self.find(piece))))
            return b"".join(out)
        return b"".join(map(self.words.__getitem__, self.find(text)))

    def encode(self, text: str | None) -> list[int]:
        return np.frombuffer(self.encode_packed(text or ""), "<u4").tolist()

    def decode(self, ids) -> str:
        table, n = self.table, len(self.table)
        try:
            raw = b"".join(map(table.__getitem__, ids))
        except IndexError:
            raw = b"".join(table[i] for i in ids if i < n)
        return raw.decode("utf-8", "replace")

    def decode_packed(self, packed: bytes) -> str:
        return self.decode(np.frombuffer(packed, "<u4").tolist())


@lru_cache(maxsize=4)
def codec(path: str) -> RankArrayBPE:
    """One codec for each worker process and vocabulary file."""
    return RankArrayBPE(path)


def encode_documents(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids array<int>): the token ids of every text; null texts as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = codec(vocabulary)
        for batch in batches:
            for at, text in enumerate(batch.column(1)):
                ids = np.frombuffer(bpe.encode_packed(text.as_py() or ""), "<u4").astype(np.int32)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, 1), pa.array([ids], pa.list_(pa.int32()))], ["id", "ids"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(run, f"id {kind}, ids array<int>").withColumnRenamed("id", id_col)


def decode_documents(encoded: DataFrame, vocabulary: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id, text): the texts of id arrays, special tokens included."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = codec(vocabulary)
        for batch in batches:
            texts = [bpe.decode(x.as_py() or []) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["id", "text"])

    kind = encoded.schema[id_col].dataType.simpleString()
    return encoded.select(id_col, ids_col).mapInArrow(run, f"id {kind}, text string").withColumnRenamed("id", id_col)


def round_trip_digests(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode and decode each text in one pass: (id, n_tokens, ids_sha256,
    decoded_sha256), without moving the ids. Null and empty texts give 0 tokens
    and the digests of nothing; repeated rows give repeated results."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = codec(vocabulary)
        for batch in batches:
            n, ids, texts = [], [], []
            for text in batch.column(1):
                packed = bpe.encode_packed(text.as_py() or "")
                n.append(len(packed) // 4)
                ids.append(hashlib.sha256(packed).hexdigest())
                texts.append(hashlib.sha256(bpe.decode_packed(packed).encode("utf-8")).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(texts, pa.string())], ["id", "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(run, f"id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string").withColumnRenamed("id", id_col)
