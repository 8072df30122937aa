"""Best-fit decreasing packing of token pieces into fixed windows.

A document of more tokens than the window is cut into full windows first; only
its remainder is packed. Pieces are dealt by a hash into shards of about
SHARD_PIECES pieces, and each shard is packed on its own, so no task holds more
than one shard whatever the size of the input. Within a shard, pieces go from
longest to shortest (ties: document id, then start) into the open window with
the least remaining capacity that still fits. A segment tree over remaining
capacities counts open windows and finds that capacity in one descent.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch

WINDOW = 2048
END_ID = 1
SHARD_PIECES = 4096


class CapacityTree:
    """Counts of open windows by remaining capacity 0..top."""

    def __init__(self, top: int):
        self.base = 1 << top.bit_length()
        self.count = [0] * (2 * self.base)

    def add(self, capacity: int, change: int) -> None:
        i, count = capacity + self.base, self.count
        while i:
            count[i] += change
            i >>= 1

    def at_least(self, need: int) -> int:
        """The smallest capacity >= need with an open window, or -1."""
        i, count = need + self.base, self.count
        if count[i]:
            return need
        while i > 1:
            if not i & 1 and count[i + 1]:
                i += 1
                while i < self.base:
                    i = 2 * i if count[2 * i] else 2 * i + 1
                return i - self.base
            i >>= 1
        return -1


def best_fit_decreasing(lengths, window: int) -> tuple[list[int], list[int]]:
    """(window number, offset) of each piece; lengths are 1..window, given from
    longest to shortest. Ties between windows go to the one filled last."""
    tree, open_at = CapacityTree(window), {}
    numbers, offsets, opened = [], [], 0
    for need in lengths:
        room = tree.at_least(need)
        if room < 0:
            number, room, opened = opened, window, opened + 1
        else:
            number = open_at[room].pop()
            tree.add(room, -1)
        numbers.append(number)
        offsets.append(window - room)
        if room > need:
            open_at.setdefault(room - need, []).append(number)
            tree.add(room - need, 1)
    return numbers, offsets


@lru_cache(maxsize=4)
def _tokenizer(path: str):
    """tiktoken over the same vocabulary: equal ids at several times the speed."""
    import json

    import tiktoken

    from .bpe import PATTERN, RankArrayBPE

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    words = RankArrayBPE(path, 1).table
    ranks = {w: i for i, w in enumerate(words) if w and i not in special.values()}
    return tiktoken.Encoding("pieces", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special), [*special]


# tiktoken's pattern engine recurses on runs of white space and overflows on very long ones.
_LONG_BLANK = re.compile(r"\s{20000}")


@lru_cache(maxsize=4)
def _plain_tokenizer(path: str):
    from .bpe import RankArrayBPE

    return RankArrayBPE(path, 10_000)


def token_ids(text: str, path: str) -> np.ndarray:
    if len(text) >= 20_000 and _LONG_BLANK.search(text):
        ids = _plain_tokenizer(path).encode(text)
    else:
        coder, special = _tokenizer(path)
        ids = coder.encode(text, allowed_special="all") if any(s in text for s in special) else coder.encode_ordinary(text)
    return np.fromiter(ids, "<u4", len(ids))


def cut_documents(docs: DataFrame, vocabulary: str, window: int = WINDOW, end_id: int = END_ID, carry_ids: bool = False) -> DataFrame:
    """One row for each piece: doc_id, start, length, ids_crc32, doc_tokens, and
    with carry_ids the packed ids as binary; lot numbers a task's pieces. Null texts
    count as empty and give the end id alone; a repeated row is a document of its own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lot = 0
        for batch in batches:
            out: list[list] = [[], [], [], [], [], []]
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = np.append(token_ids(text.as_py() or "", vocabulary), np.uint32(end_id)).astype("<u4")
                for start in range(0, len(ids), window):
                    raw = ids[start : start + window].tobytes()
                    for column, value in zip(out, (doc, start, len(raw) // 4, zlib.crc32(raw), len(ids), raw if carry_ids else None)):
                        column.append(value)
            lots = pa.array(range(lot, lot + len(out[0])), pa.int64())
            lot += len(out[0])
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[0], batch.schema.field(0).type), *(pa.array(x, pa.int64()) for x in out[1:5]), lots, pa.array(out[5], pa.binary())],
                ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "lot", "ids"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    out = docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, lot long, ids binary")
    return out if carry_ids else out.drop("ids")


def pack_pieces(pieces: DataFrame, window: int = WINDOW, shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """Adds sequence_id, offset, fill (tokens of the sequence) and padded_length
    to pieces (doc_id, start, length, ...). padded_length is the window, or the
    fill itself where that is a power of two. A column lot, where there is one, deals
    pieces that are otherwise equal to different shards. An empty table gives an empty
    one; a piece longer than the window is an error."""
    n = pieces.count()
    shards = max(1, math.ceil(n / shard_pieces))
    names = [f"{f.name} {f.dataType.simpleString()}" for f in pieces.schema.fields]

    def run(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["length", "doc_id", "start"], ascending=[False, True, True], kind="stable").reset_index(drop=True)
        if len(part) and not part.length.between(1, window).all():
            raise ValueError(f"pieces hold 1 to {window} tokens")
        shard = int(part.pop("shard").iloc[0])
        numbers, offsets = best_fit_decreasing(part.length.tolist(), window)
        part["sequence_id"] = np.array(numbers, "int64") * shards + shard
        part["offset"] = np.array(offsets, "int64")
        fill = part.groupby("sequence_id").length.transform("sum").astype("int64")
        part["fill"] = fill
        part["padded_length"] = np.where(fill & (fill - 1) == 0, fill, window)
        return part

    dealt = pieces.withColumn("shard", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32", *(["lot"] if "lot" in pieces.columns else [])), F.lit(shards)))
    return dealt.groupBy("shard").applyInPandas(run, ", ".join([*names, "sequence_id long", "offset long", "fill long", "padded_length long"]))


def pack_documents(docs: DataFrame, vocabulary: str, window: int = WINDOW) -> DataFrame:
    """Tokenise, cut and pack whole documents; the pieces are written to the
    shared folder between the two steps, so tokens are made once. Columns other
    than doc_id and text are not read."""
    scratch = Scratch(docs.sparkSession, "packing")
    return pack_pieces(scratch.save(cut_documents(docs, vocabulary, window)), window).drop("lot")
