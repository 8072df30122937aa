"""Line dedup, near duplicates and vector operators against brute force."""

import numpy as np
import pandas as pd
import pytest

pytest.importorskip("tidecast.llm")
from pyspark.sql import functions as F

from tidecast.llm import ann, bagminhash, line_dedup, queries, rabitq
from tidecast.llm.common import Scratch
from tidecast.llm.graph import components


def brute_components(n, links):
    label = list(range(n))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for a, b in links:
        a, b = root(a), root(b)
        label[max(a, b)] = min(a, b)
    return [root(i) for i in range(n)]


def mutated(rng, words, vocabulary, changes):
    words = list(words)
    for _ in range(changes):
        words[rng.integers(len(words))] = vocabulary[rng.integers(len(vocabulary))]
    return " ".join(words)


@pytest.fixture(scope="module")
def copied_texts():
    rng = np.random.default_rng(5)
    vocabulary = ["w%d" % i for i in range(4000)]
    texts = [None, "", "  ", "one two", "one two", "one  two", "x " * 400, "x " * 380]
    for size in (2, 3, 40, 120):
        base = [vocabulary[i] for i in rng.integers(0, 4000, 200)]
        texts += [mutated(rng, base, vocabulary, int(rng.integers(0, 6))) for _ in range(size)]
    texts += [" ".join(vocabulary[i] for i in rng.integers(0, 4000, int(rng.integers(1, 300)))) for _ in range(60)]
    chain = [vocabulary[i] for i in rng.integers(0, 4000, 150)]
    for step in range(8):  # each like its neighbour, the ends unlike
        texts.append(" ".join(chain[step * 8 : step * 8 + 90]))
    return texts


def test_near_duplicates_match_brute_force(spark, copied_texts):
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(copied_texts)], "doc_id long, text string, bands string, node int")
    got = bagminhash.near_duplicates(docs.repartition(3)).toPandas().sort_values("doc_id")
    bags = [bagminhash.shingle_counts((t or "").split()) for t in copied_texts]
    links = [(i, j) for i in range(len(bags)) for j in range(i) if bagminhash.weighted_jaccard(bags[i], bags[j]) >= 0.8]
    want = brute_components(len(bags), links)
    assert got.component_id.tolist() == want
    assert got.kept.tolist() == [i == w for i, w in enumerate(want)]


def test_near_duplicates_repeated_rows_and_empty_table(spark):
    rows = spark.createDataFrame([(1, "a b c d e f"), (1, "a b c d e f"), (2, "a b c d e f"), (3, None)], "doc_id long, text string")
    got = bagminhash.near_duplicates(rows).toPandas().sort_values(["doc_id"])
    assert got.doc_id.tolist() == [1, 1, 2, 3] and got.component_id.tolist() == [1, 1, 1, 3]
    assert bagminhash.near_duplicates(rows.limit(0)).count() == 0


def test_keep_one_drops_no_text_that_was_not_compared(spark):
    words = ["%s%d" % (a, i) for a in "abcd" for i in range(60)]
    text = {a: " ".join(w for w in words if w[0] == a) for a in "abcd"}
    rows = [(None, text["a"], 1), (None, text["b"], 2), (5, text["c"], 3), (5, text["d"], 4), (5, text["d"], 5), (7, text["c"], 6), (3, text["d"] + " end", 7), (4, None, 8), (4, "", 9)]
    got = bagminhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string, n int")).toPandas()
    assert sorted(got.n)[:4] == [1, 2, 3, 7] and sorted(got.n)[4:] in ([8], [9])


def test_near_duplicates_compare_every_text_of_an_id(spark):
    texts = {a: " ".join("%s%d" % (a, i) for i in range(60)) for a in "abcdefgh"}
    rows = [(1, t) for t in texts.values()] + [(10 + i, t + " end") for i, t in enumerate(texts.values())] + [(None, "x " + texts["a"]), (None, "no other text is like this one")]
    got = bagminhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).toPandas()
    assert len(got) == len(rows)
    assert (got[got.doc_id >= 10].component_id == 1).all() and sorted(got[got.doc_id.isna()].component_id.fillna(-1)) == [-1, 1]


def test_signatures_are_unbiased():
    rng, errors = np.random.default_rng(3), []
    for _ in range(60):
        h = np.sort(rng.integers(1, 2**62, 50).astype(np.uint64))
        one = rng.integers(1, 9, 50)
        two = np.where(rng.random(50) < 0.6, one, rng.integers(1, 40, 50))
        a, b = (h[:45], one[:45]), (h[3:], two[3:])
        s = bagminhash.signatures([a, b], 512)
        errors.append((s[0] == s[1]).mean() - bagminhash.weighted_jaccard(a, b))
    assert abs(np.mean(errors)) < 0.01 and np.std(errors) < 0.04


def test_prefix_pairs_lose_no_link(spark):
    """Multisets of many sizes around a common text: every pair over the threshold in
    different components is found, also where most texts are of one component."""
    rng = np.random.default_rng(11)
    base = rng.integers(1, 2**62, 120).astype(np.uint64)
    bags = []
    for i in range(150):
        own = np.concatenate([rng.choice(base, int(rng.integers(60, 121)), replace=False), rng.integers(1, 2**62, int(rng.integers(0, 25))).astype(np.uint64)])
        bags.append(np.unique(np.concatenate([own, own[: i % 7]]), return_counts=True))
    label = [0 if i % 3 else i for i in range(150)]
    nodes = spark.createDataFrame([(i, c) for i, c in enumerate(label)], "node long, component long")
    packed = spark.createDataFrame([(i, bytearray(h.tobytes() + c.astype(np.int32).tobytes())) for i, (h, c) in enumerate(bags)], "node long, bag binary")
    got = {tuple(r) for r in bagminhash._prefix_pairs(nodes, packed, 0.8, Scratch(spark, "t")).collect()}
    want = {(i, j) for i in range(150) for j in range(i) if label[i] != label[j] and bagminhash.weighted_jaccard(bags[i], bags[j]) >= 0.8}
    assert want and want <= got and all(label[a] != label[b] for a, b in got)
    assert len(got) < 0.1 * sum(label[i] != label[j] for i in range(150) for j in range(i))


def test_word_hashes():
    words = ["a", "b", "ab", "ba", "\u00e9", "x" * 256, "x" * 257, "y" * 100_000, "\ud800", "-"] * 2_000
    got = bagminhash.word_hashes(list(words))
    assert (got[:10] == got[-10:]).all() and len(set(got.tolist())) == 10
    assert len(bagminhash.word_hashes([])) == 0


def test_components(spark):
    rng = np.random.default_rng(2)
    links = [(int(a), int(b)) for a, b in rng.integers(0, 300, (260, 2))] + [(i, i + 1) for i in range(400, 460)] + [(7, 7)]
    got = components(spark.createDataFrame(links, "a long, b long"), Scratch(spark, "t")).toPandas()
    want = brute_components(500, links)
    nodes = {x for a, b in links if a != b for x in (a, b)}
    assert dict(zip(got.node, got.component)) == {n: want[n] for n in nodes} and len(got) == len(nodes)


def vectors():
    rng = np.random.default_rng(4)
    base = rng.normal(size=(6, 16))
    rows = [base[i % 6] + 0.1 * rng.normal(size=16) * (i % 4) for i in range(160)]
    rows += [base[0], base[0], 3 * base[0], np.zeros(16), np.full(16, np.nan), rng.normal(size=8)]
    out = [(i, [float(x) for x in v]) for i, v in enumerate(rows)]
    return out + [(200, None), (201, []), (202, [1.0, None] + [0.0] * 14), (203, [float("inf")] + [0.0] * 15)]


def test_near_vectors_match_brute_force(spark):
    rows = vectors()
    df = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<double>, id int, links int")
    got = rabitq.near_vectors(df, block_rows=50).toPandas().set_index("vec_id").sort_index()
    ok = {i: np.array(v) for i, v in rows if v and None not in v and np.isfinite(v).all() and np.any(v)}
    links = {i: [j for j in ok if j != i and len(ok[j]) == len(ok[i]) and ok[i] @ ok[j] / np.sqrt((ok[i] @ ok[i]) * (ok[j] @ ok[j])) >= 0.9] for i in ok}
    want = brute_components(300, [(i, j) for i in links for j in links[i]])
    for i, _ in rows:
        assert got.n_links[i] == len(links.get(i, [])), i
        assert got.component_id[i] == want[i] and got.kept[i] == (want[i] == i)
    assert rabitq.near_vectors(df.limit(0)).count() == 0


def test_estimates_are_unbiased_and_codes_lose_no_link():
    rng = np.random.default_rng(9)
    x = rng.normal(size=(400, 64))
    x[40:80] = x[:40] + 0.4 * rng.normal(size=(40, 64))
    bits, factor, turned = rabitq.encode(x)
    estimate = rabitq.signs(bits, 64) @ turned.T / factor[:, None]
    unit = x / np.sqrt((x**2).sum(1))[:, None]
    off = ~np.eye(400, dtype=bool)
    assert bits.shape == (400, 8) and abs((estimate - unit @ unit.T)[off].mean()) < 0.005
    linked = (unit @ unit.T >= 0.9) & off
    assert linked.any() and (estimate >= rabitq.least_estimate(factor, 64, 0.9)[:, None])[linked].all()
    left, right = rabitq.surviving_rows(turned, bits, factor, 0.9, True)
    assert (left | right)[linked.any(0)].all() and not (left | right).all()


def test_nearest_matches_brute_force(spark):
    rows = vectors() + [(300, vectors()[0][1]), (301, vectors()[0][1])]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<double>, query int")
    got = ann.nearest(df, F.col("vec_id") % 20 == 0, block_rows=60).toPandas()
    ok = {i: np.array(v) for i, v in rows if v and None not in v and np.isfinite(v).all() and np.any(v)}
    for q in [i for i in ok if i % 20 == 0]:
        want = sorted((float(np.sqrt(((ok[q] - ok[j]) ** 2).sum())), j) for j in ok if j != q and len(ok[j]) == len(ok[q]))[:10]
        mine = got[got.query_id == q].sort_values("rank")
        assert mine["rank"].tolist() == list(range(1, len(want) + 1)) and np.allclose(mine.score, [d for d, _ in want])
        assert [(round(d, 9), i) for d, i in zip(mine.score, mine.vec_id)] == [(round(d, 9), i) for d, i in want]
    assert ann.nearest(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_vectors_of_one_id_and_of_any_length(spark):
    rows = [(1, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 0.01]), (3, [0.01, 1.0]), (4, [-1e200, 0.0]), (5, [-1e200, 0.0]), (6, [-1e-170, -1e-170]), (7, [-1e-170, -1e-170])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = rabitq.near_vectors(df).toPandas()
    assert sorted(zip(got.vec_id, got.n_links, got.component_id)) == [(1, 1, 1), (1, 1, 1), (2, 1, 1), (3, 1, 1), (4, 1, 4), (5, 1, 4), (6, 1, 6), (7, 1, 6)]
    near = ann.nearest(df, F.col("vec_id") > 0, k=2, block_rows=3).toPandas()
    assert len(near) == 2 * len(rows) and sorted(near.query_id.unique()) == [1, 2, 3, 4, 5, 6, 7]
    one = near[near.query_id == 1]
    assert sorted(one[one["rank"] == 1].vec_id) == [2, 3] and np.allclose(one[one["rank"] == 1].score, 0.01)
    assert near[near.query_id == 4].sort_values("rank").vec_id.tolist()[0] == 5
    assert near[(near.query_id == 6) & (near["rank"] == 1)].iloc[0].tolist() == [6, 1, 7, 0.0]


def lines_frame(spark):
    rng = np.random.default_rng(8)
    word = lambda: "".join(rng.choice(list("abcdefgh"), 5))
    rows = []
    for i in range(40):
        own = [" ".join(word() for _ in range(12)) for _ in range(3)]
        shared = ["Copyright the authors of this text", f"Page {i} of 40 in this book", f"Please contact the office of {word()} about any of these things"][: 1 + i % 3]
        rows.append((i, "\n".join([*own[:2], *shared, "ok", "", own[2]]), "en"))
    return spark.createDataFrame(rows + [(40, None, "en"), (41, "", "en"), (42, "a b\na b\na b c\na b c", "en"), (3, rows[3][1], "en")], "doc_id long, text string, leaf string")


def test_line_dedup_drops_recurring_templates(spark):
    got = line_dedup.dedup_lines(lines_frame(spark), ("leaf",)).toPandas()
    text = got.drop_duplicates("doc_id").set_index("doc_id").text
    for start in ("Copyright the authors", "Page ", "Please contact the office"):
        assert [i for i in text.index if start in text[i]] == [min(i for i in range(40) if i % 3 >= ("C", "Pa", "Pl").index(start[: 2 if start[0] == "P" else 1]))]
    assert got.n_dropped.sum() > 40 and (got.doc_id == 3).sum() == 2
    assert text[40] == "" and text[42] == "a b\na b\na b c\na b c"
    assert [i for i in range(40) if "\nok\n" in text[i]] == [0]  # short lines go from ten documents on


@pytest.mark.parametrize("name", ["fixture", "sf0.01"])
def test_line_dedup_matches_sql(spark, name):
    import duckdb

    docs = lines_frame(spark).drop("leaf") if name == "fixture" else spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    documents = docs.toPandas()  # noqa: F841
    want = duckdb.sql(line_dedup.ORACLE_SQL).df().sort_values(["doc_id"], kind="stable").reset_index(drop=True)
    got = line_dedup.dedup_lines(docs).toPandas().sort_values(["doc_id"], kind="stable").reset_index(drop=True)
    pd.testing.assert_frame_equal(got[want.columns], want, check_dtype=False)
    assert (got.n_dropped > 0).any()


def line_stage(spark, rows):
    docs = spark.createDataFrame([(*r, "en", "x") for r in rows], "doc_id long, text string, lang string, source string")
    return pytest.importorskip("corpus_pipeline").line_stage(spark, docs, "").toPandas().set_index("doc_id").text


def test_line_dedup_long_documents_clashing_columns_and_empty_table(spark):
    many = "\n".join(["one line that stands here"] * 30_000 + ["own end"])
    rows = [(i, many if i == 9 else "one line that stands here\nown %d text" % i, "x", 1) for i in range(10)] + [(20, None, "x", 2), (21, "   \n\n  ", "x", 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, N_dropped string, places int")
    got = line_dedup.dedup_lines(docs, ("N_dropped", "places")).toPandas().set_index("doc_id")
    assert list(got.columns) == ["text", "n_lines", "n_dropped", "places"]
    assert got.text[9] == "own end" and got.n_dropped[9] == 30_000 and got.text[21] == "   \n\n  " and got.places[20] == 2
    assert line_dedup.dedup_lines(docs.limit(0)).count() == 0


@pytest.mark.parametrize("n", [100, 1_000, 10_000])
def test_two_field_template_goes_at_every_size(spark, n):
    rng = np.random.default_rng(n)
    rows = [(i, f"Our shop in {'c' + chr(97 + a % 25) + chr(97 + a // 25)} greets all {'v' + chr(97 + b % 25) + chr(97 + b // 25)} guests") for i, (a, b) in enumerate(rng.integers(0, 50, (n, 2)))]
    rows = [(i, t + " today") for i, t in rows]
    got = line_stage(spark, rows)
    assert len(got) == n and got.index[got != ""].tolist() == [0]


def test_long_passages_go_from_two_documents_on(spark):
    passage = " ".join("w" + chr(97 + i % 26) + chr(97 + i // 26) for i in range(60))
    text = line_stage(spark, [(i, f"own{i}\n\n" + (passage if i in (3, 7) else f"no {i}")) for i in range(12)])
    assert [i for i in text.index if passage in text[i]] == [3] and all(text[i].startswith(f"own{i}\n") for i in range(12))


def test_short_lines_go(spark):
    text = line_stage(spark, [(i, f"own{i}\nRead more\n" + ("ok" if i < 9 else "")) for i in range(12)])
    assert [i for i in text.index if "Read more" in text[i]] == [0]
    assert all("ok" in text[i] for i in range(9)) and all(f"own{i}\n" in text[i] for i in range(12))


def test_registered_queries_run(spark, sf_dir):
    for name in ("op1_line_dedup", "op4_bagminhash", "op5_rabitq", "op6_ann"):
        assert queries.queries()[name](spark, sf_dir).count() > 0
