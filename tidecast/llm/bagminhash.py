"""Near duplicates by weighted MinHash of word-shingle multisets (BagMinHash).

A text is the multiset of its runs of five words (a shorter text is one shingle
of all its words). For each shingle, independent Poisson processes run over
register, time and weight, one for each dyadic part of the weight axis: (0, 1],
(1, 2], (2, 4], ... A shingle of weight w owns the points below w: whole parts
without a look at each point, the part that holds w by thinning. A register's
value is the point that comes first over all shingles, so two texts agree in a
register with a probability equal to their weighted Jaccard similarity. Points
are made in order of time only up to a horizon at which a text's registers are
full (else it is doubled), so most shingles cost one draw.

BANDS bands of ROWS registers make buckets. Texts with the same words are one
class from the start. In each bucket every class is compared with one root; the
exact weighted Jaccard of the multisets decides, and verified links are joined
into components. Buckets that still hold several components get new roots by another
order, for STAR_ROUNDS - 1 rounds; then all classes of such buckets go through an
exact filter on rare shingles, their places and sizes, and every pair of different
components that passes it is compared. So no link between candidates goes missing, and
a group of many near copies costs about one comparison for each copy, not each pair.

Defined results: null texts count as empty; texts without words are copies of
each other; repeated rows are returned as often as they come, under one class;
classes go by text alone, so unlike texts under one id, or under no id, are
compared like any others; component_id is the smallest id of a component, null
where none of its rows has one, and two components may carry the same one where an
id repeats; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch
from .graph import components

SHINGLE = 5
THRESHOLD = 0.8
BANDS, ROWS = 30, 8
REGISTERS = BANDS * ROWS
STAR_ROUNDS = 2
BROADCAST_IDS = 1_000_000
SIZE_STEP = 1.05
_BLOCK_WORDS, _BLOCK_TEXTS = 100_000, 2_000
_LONG_WORD = 256
_STEP = 8_192
_U = np.uint64
_GOLD, _M1, _M2 = _U(0x9E3779B97F4A7C15), _U(0xBF58476D1CE4E5B9), _U(0x94D049BB133111EB)

_PLACE = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = (x ^ (x >> _U(30))) * _M1
    x = (x ^ (x >> _U(27))) * _M2
    return x ^ (x >> _U(31))


def _uniform(x: np.ndarray) -> np.ndarray:
    return ((x >> _U(11)).astype(np.float64) + 0.5) * 2.0**-53


# A word is the sum of a number for each byte times an odd base to the byte's place.
_BYTE = _mix(np.arange(1, 257, dtype=np.uint64) * _GOLD)
_BYTE[32] = 0
_POWER = np.cumprod(np.concatenate(([1], np.full(4 * _LONG_WORD, 0x2545F4914F6CDD1B, np.uint64))).astype(np.uint64))


def word_hashes(words: list[str]) -> np.ndarray:
    """64-bit hashes of words without white space, some thousand words at a time."""
    out = np.empty(len(words), np.uint64)
    for at in range(0, len(words), _STEP):
        part = words[at : at + _STEP]
        long = [i for i, w in enumerate(part) if len(w) > _LONG_WORD] if max(map(len, part)) > _LONG_WORD else []
        digests = [xxhash.xxh3_64_intdigest(part[i].encode("utf-8", "surrogatepass")) for i in long]
        for i in long:
            part[i] = "-"
        raw = np.frombuffer(" ".join(part).encode("utf-8", "surrogatepass"), np.uint8)
        starts = np.concatenate(([0], np.flatnonzero(raw == 32) + 1))
        place = np.arange(len(raw)) - np.repeat(starts, np.diff(starts, append=len(raw)))
        out[at : at + len(part)] = np.add.reduceat(_BYTE[raw] * _POWER[place], starts)
        out[[at + i for i in long]] = np.array(digests, np.uint64)
    return out


def shingle_counts(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes and how often each occurs."""
    return _counted(word_hashes(words))


def _counted(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    n = len(ids)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    k = min(n, SHINGLE)
    mixed = np.zeros(n - k + 1, np.uint64)
    for i in range(k):
        mixed += ids[i : n - k + 1 + i] * _PLACE[i]
    return np.unique(_mix(mixed + _U(k)), return_counts=True)


def _bags_of(texts: list[list[str]]) -> list[tuple[np.ndarray, np.ndarray]]:
    ids = word_hashes([w for words in texts for w in words])
    ends = np.cumsum([len(words) for words in texts])
    return [_counted(ids[end - len(words) : end]) for words, end in zip(texts, ends)]


def weighted_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    total = int(a[1].sum() + b[1].sum())
    if not total:
        return 1.0
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    low = int(np.minimum(a[1][i], b[1][j]).sum())
    return low / (total - low)


def _points(row, element, weight, horizon, registers):
    """(slot, time, point) of every point of some shingles up to their text's horizon."""
    # one process for each shingle and dyadic part: key, size of the part, cells owned
    rows, keys, parts, owned = [row], [element], [np.ones(len(row))], [np.ones(len(row))]
    level, low = 1, 1
    while (more := weight > low).any():
        rows.append(row[more])
        keys.append(_mix(element[more] + _U(level)))
        parts.append(np.full(more.sum(), float(low)))
        owned.append(np.minimum(weight[more] - low, low).astype(np.float64))
        level, low = level + 1, low * 2
    row, key, part, own = (x[0] if level == 1 else np.concatenate(x) for x in (rows, keys, parts, owned))
    thinned = level > 1
    # time runs in units of 1 / (registers * part) here, so gaps are unit exponentials
    limit = horizon[row] * part * registers
    time, draw, slots, times, points = np.zeros(len(row)), 0, [], [], []
    while len(row):
        steps = 1 if draw < 3 else 8 if draw < 11 else 64
        numbers = np.arange(draw + 1, draw + 1 + steps, dtype=np.uint64) * _GOLD
        point = _mix(key[:, None] + numbers)
        reached = time[:, None] - np.log(_uniform(point)).cumsum(1)
        at, step = np.nonzero(reached <= limit[:, None])
        hit, second = point[at, step], _mix(point[at, step] ^ _M2)
        if thinned:
            mine = _uniform(_mix(second ^ _M1)) * part[at] < own[at]
            at, hit, second, step = at[mine], hit[mine], second[mine], step[mine]
        slots.append(row[at] * registers + (second % _U(registers)).astype(np.int64))
        times.append(reached[at, step] / part[at])
        points.append(hit)
        time, draw = reached[:, -1], draw + steps
        on = time <= limit
        row, key, part, own, time, limit = (x[on] for x in (row, key, part, own, time, limit))
    return np.concatenate(slots), np.concatenate(times), np.concatenate(points)


def signatures(bags: list[tuple[np.ndarray, np.ndarray]], registers: int = REGISTERS) -> np.ndarray:
    """One row of register values for each multiset; empty ones get zeros. Points
    are made for _STEP shingles at a time, whatever the length of a text."""
    out = np.zeros((len(bags), registers), np.uint64)
    todo = [i for i, (h, _) in enumerate(bags) if len(h)]
    stretch = np.full(len(bags), np.log(registers) + 3.0)
    while todo:
        row = np.repeat(np.arange(len(todo)), [len(bags[i][0]) for i in todo])
        element, weight = np.concatenate([bags[i][0] for i in todo]), np.concatenate([bags[i][1] for i in todo])
        horizon = stretch[todo] / np.array([bags[i][1].sum() for i in todo], np.float64)
        first_time, first_point = np.full(len(todo) * registers, np.inf), np.zeros(len(todo) * registers, np.uint64)
        for at in range(0, len(row), _STEP):
            some = slice(at, at + _STEP)
            slot, when, point = _points(row[some], element[some], weight[some], horizon, registers)
            np.minimum.at(first_time, slot, when)
            won = when == first_time[slot]
            first_point[slot[won]] = point[won]
        full = np.isfinite(first_time).reshape(len(todo), registers).all(1)
        for at in np.flatnonzero(full):
            out[todo[at]] = first_point[at * registers : (at + 1) * registers]
        todo = [i for at, i in enumerate(todo) if not full[at]]
        stretch[todo] *= 2
    return out


def band_hashes(signature: np.ndarray, bands: int = BANDS) -> np.ndarray:
    n, registers = signature.shape
    grouped = signature.reshape(n, bands, registers // bands)
    out = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64) * _GOLD, (n, bands)).copy()
    for k in range(grouped.shape[2]):
        out = _mix(out * _M2 + grouped[:, :, k])
    return out.view(np.int64)


def _blocks(batch: pa.RecordBatch) -> Iterator[tuple[int, list[list[str]]]]:
    """(first row, words of each text) with about _BLOCK_WORDS words or _BLOCK_TEXTS texts together."""
    start, held, n = 0, [], 0
    for at, text in enumerate(batch.column(1)):
        words = (text.as_py() or "").split()
        held.append(words)
        n += len(words)
        if n >= _BLOCK_WORDS or len(held) >= _BLOCK_TEXTS:
            yield start, held
            start, held, n = at + 1, [], 0
    if held:
        yield start, held


def _text_hash() -> Column:
    return F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash")


def sign_documents(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, key_high, key_low, bands): the fingerprint of the word sequence
    and the bucket of each band; no buckets for texts without words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, texts in _blocks(batch):
                prints = np.array([np.frombuffer(hashlib.md5(" ".join(w).encode("utf-8", "surrogatepass")).digest(), "<i8") for w in texts])
                bags = _bags_of(texts)
                bands = band_hashes(signatures(bags))
                listed = pa.array([b if len(bag[0]) else [] for b, bag in zip(bands, bags)], pa.list_(pa.int64()))
                own = [batch.column(k).slice(start, len(texts)) for k in (0, 2)]
                yield pa.RecordBatch.from_arrays([*own, pa.array(prints[:, 0]), pa.array(prints[:, 1]), listed], ["doc_id", "text_hash", "key_high", "key_low", "bands"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", _text_hash()).mapInArrow(run, "doc_id long, text_hash long, key_high long, key_low long, bands array<long>")


def _bags(docs: DataFrame) -> DataFrame:
    """(node, bag): sorted shingle hashes, then their counts, as binary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, texts in _blocks(batch):
                bags = [h.tobytes() + c.astype(np.int32).tobytes() for h, c in _bags_of(texts)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(start, len(texts)), pa.array(bags, pa.binary())], ["node", "bag"])

    return docs.select("node", "text").mapInArrow(run, "node long, bag binary")


def _unpack(bag: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = len(bag) // 12
    return np.frombuffer(bag, np.uint64, n), np.frombuffer(bag, np.int32, n, 8 * n)


def _verified(pairs: DataFrame, bags: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b) whose exact similarity reaches the threshold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple] = {}
        for batch in batches:
            a, b = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            keep = []
            for i in range(batch.num_rows):
                if b[i] not in held:
                    if len(held) >= 64:
                        held.clear()
                    held[b[i]] = _unpack(batch.column(3)[i].as_py())
                keep.append(weighted_jaccard(_unpack(batch.column(2)[i].as_py()), held[b[i]]) >= threshold)
            if any(keep):
                yield batch.select([0, 1]).filter(pa.array(keep))

    joined = pairs.join(bags.select(F.col("node").alias("a"), F.col("bag").alias("bag_a")), "a").join(bags.select(F.col("node").alias("b"), F.col("bag").alias("bag_b")), "b")
    return joined.select("a", "b", "bag_a", "bag_b").mapInArrow(run, "a long, b long")


def _prefix_pairs(nodes: DataFrame, bags: DataFrame, threshold: float, scratch: Scratch) -> DataFrame:
    """Every pair (a, b) of nodes in different components that may reach the threshold,
    by an exact filter on prefixes, positions and sizes. With shingles in order from rare
    to frequent, what two multisets share lies at and behind the first shingle that both
    hold, so at that place neither may have less left than the overlap that the
    threshold asks of their sizes. A shingle at some place of one text therefore meets
    only partners up to a size that falls with the place; sizes are classes in steps of
    SIZE_STEP, and a list of texts is made for each shingle and class, for the smaller
    text of a pair. The component most frequent in a list never meets itself there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for node, component, bag in zip(*(batch.column(i).to_pylist() for i in range(3))):
                h, c = _unpack(bag)
                n = len(h)
                yield pa.RecordBatch.from_arrays([pa.array([node] * n, pa.int64()), pa.array([component] * n, pa.int64()), pa.array(h.view(np.int64)), pa.array(c.astype(np.int64)), pa.array([int(c.sum())] * n, pa.int64())], ["node", "component", "shingle", "times", "total"])

    rows = scratch.save(nodes.join(bags, "node").select("node", "component", "bag").mapInArrow(run, "node long, component long, shingle long, times long, total long"))
    seen = rows.groupBy("shingle").agg(F.count("*").alias("seen")).where("seen > 1")
    order = Window.partitionBy("node").orderBy(F.coalesce("seen", F.lit(1)), "shingle").rowsBetween(Window.unboundedPreceding, -1)
    ranked = rows.join(seen, "shingle", "left").withColumn("before", F.coalesce(F.sum("times").over(order), F.lit(0)))
    most = F.col("total") / threshold - F.col("before") * ((1 + threshold) / threshold) + 1e-9  # size of a partner
    least = F.col("total") * threshold - 1e-9
    prefix = ranked.where(F.col("seen").isNotNull()).withColumns({"most": most, "least": least, "rest": F.col("total") - F.col("before")})
    prefix = scratch.save(prefix.where("most >= least").select("node", "component", "shingle", "total", "rest", "most", "least"))

    size = lambda x: F.floor(F.log(x) / F.lit(math.log(SIZE_STEP))).cast("int")
    key = ["shingle", "size"]
    smaller = prefix.where("most >= total").select("node", "component", "shingle", "total", "rest", size(F.col("total").cast("double")).alias("size"))
    lists = smaller.groupBy(*key, "component").agg(F.count("*").alias("n")).groupBy(*key).agg(F.max(F.struct("n", "component")).alias("main"))
    lists = scratch.save(lists.select(*key, F.col("main.component").alias("main")))
    # side 0: the others of a list meet all; side 1: the main component meets the others
    smaller = smaller.join(lists, key).withColumn("side", (F.col("component") == F.col("main")).cast("int"))
    sizes = F.explode(F.sequence(size(F.col("least")), size(F.least("most", F.col("total").cast("double"))))).alias("size")
    sides = F.explode(F.when(F.col("component") == F.col("main"), F.array(F.lit(0))).otherwise(F.array(F.lit(0), F.lit(1)))).alias("side")
    larger = prefix.select("node", "component", "shingle", "total", "rest", sizes).join(lists, key).select(*key, F.col("node").alias("b"), F.col("component").alias("with"), F.col("total").alias("weight"), F.col("rest").alias("left"), sides)
    first = (F.col("total") < F.col("weight")) | ((F.col("total") == F.col("weight")) & (F.col("node") < F.col("b")))
    enough = F.least("rest", "left") >= (F.col("total") + F.col("weight")) * (threshold / (1 + threshold)) - 1e-9
    met = smaller.join(larger, [*key, "side"]).where(first & (F.col("component") != F.col("with")) & enough)
    return met.select(F.greatest("node", "b").alias("a"), F.least("node", "b").alias("b"))


def _heads(docs: DataFrame, threshold: float) -> DataFrame:
    """(doc_id, text_hash, head) of every row: head is the (doc_id, text_hash) that comes
    first among the rows with an id reachable by links of similarity >= threshold."""
    scratch = Scratch(docs.sparkSession, "near")
    signed = scratch.save(sign_documents(docs))
    # numbers of classes are fixed as they are written, and no two classes share one
    row = F.struct("doc_id", "text_hash")
    classes = signed.groupBy("key_high", "key_low").agg(F.min(F.when(F.col("doc_id").isNotNull(), row)).alias("head"), F.min(row).alias("sample"), F.first("bands").alias("bands"))
    classes = scratch.save(classes.withColumn("node", F.monotonically_increasing_id()))
    spread = classes.select("node", F.explode("bands").alias("bucket"))
    full = spread.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    shared = scratch.save(spread.join(full, "bucket"))  # of buckets with several classes
    # the root of a bucket is its most central class: what shares most places with others
    central = shared.groupBy("node").agg(F.sum("n").alias("central"))
    ranked = shared.select("bucket", "node").join(central, "node")
    roots = ranked.groupBy("bucket").agg(F.max(F.struct("central", (-F.col("node")).alias("least"))).alias("root"))
    rows = scratch.save(shared.select("bucket", "node").join(roots.select("bucket", (-F.col("root.least")).alias("root")), "bucket"))
    scratch.drop(shared)

    # the text of one row stands for its class
    involved = scratch.save(classes.join(rows.select("node").distinct(), "node").select("node", "sample.*"))
    few = involved.count() <= BROADCAST_IDS
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", _text_hash())
    same = [texts["doc_id"].eqNullSafe(involved["doc_id"]), texts["text_hash"] == involved["text_hash"]]
    bags = scratch.save(_bags(texts.join(F.broadcast(involved) if few else involved, same).select("node", "text")).dropDuplicates(["node"]))

    tested = scratch.save(rows.where("node != root").select(F.greatest("node", "root").alias("a"), F.least("node", "root").alias("b")).distinct())
    found = scratch.save(components(_verified(tested, bags, threshold), scratch))
    for turn in range(1, STAR_ROUNDS + 1):
        labelled = rows.select("bucket", "node").join(found, "node", "left").select("bucket", "node", F.coalesce("component", "node").alias("component"))
        mixed = labelled.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.min(F.struct(F.xxhash64("node", F.lit(turn)), "node", "component")).alias("pick")).where("low < high")
        open_rows = labelled.join(mixed.select("bucket", F.col("pick.node").alias("root"), F.col("pick.component").alias("other")), "bucket")
        if turn < STAR_ROUNDS:
            pairs = open_rows.where("component != other").select(F.greatest("node", "root").alias("a"), F.least("node", "root").alias("b"))
        else:
            pairs = _prefix_pairs(open_rows.select("node", "component").distinct(), bags, threshold, scratch)
        fresh = scratch.save(pairs.distinct().join(tested, ["a", "b"], "left_anti"))
        if not fresh.count():
            continue
        more = scratch.save(_verified(fresh, bags, threshold))
        if turn < STAR_ROUNDS:
            tested = scratch.save(tested.unionByName(fresh))
        if more.count():
            found = scratch.save(components(found.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(more), scratch))
    linked = found.join(classes.select("node", "head"), "node")
    heads = linked.select("node", "component").join(linked.groupBy("component").agg(F.min("head").alias("first")), "component").select("node", "first")
    merged = scratch.save(classes.select("key_high", "key_low", "node", "head").join(heads, "node", "left").select("key_high", "key_low", F.coalesce("first", "head").alias("head")))
    return signed.select("doc_id", "text_hash", "key_high", "key_low").join(merged, ["key_high", "key_low"]).select("doc_id", "text_hash", "head")


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, component_id, kept) of every row: component_id is the smallest
    doc_id reachable by links of similarity >= threshold, kept marks it."""
    component = F.col("head.doc_id")
    return _heads(docs, threshold).select("doc_id", component.alias("component_id"), (F.col("doc_id") == component).alias("kept"))


def keep_one(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs that stay: of each group of near duplicates the one with the
    smallest doc_id (of several texts under that id, the one of the smallest hash),
    and one row of it where id and text are repeated. Rows that only share an id
    stay, and so do all rows with a null id."""
    left = F.col("doc_id").isNotNull() & (F.struct("doc_id", "text_hash") != F.col("head"))
    gone = Scratch(docs.sparkSession, "gone").save(_heads(docs, threshold).where(left).select(F.col("doc_id").alias("gone_id"), F.col("text_hash").alias("gone_hash")).distinct())
    repeated = docs.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").limit(1).count()
    few = gone.count() <= BROADCAST_IDS
    same = (F.col("doc_id").cast("long") == F.col("gone_id")) & (_text_hash() == F.col("gone_hash"))
    stay = docs.join(F.broadcast(gone) if few else gone, same, "left_anti")
    if not repeated:
        return stay
    once = stay.where("doc_id is not null").withColumn("kept_hash", _text_hash()).dropDuplicates(["doc_id", "kept_hash"]).drop("kept_hash")
    return once.unionByName(stay.where("doc_id is null"))
