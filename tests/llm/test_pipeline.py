"""Each stage of the corpus pipeline on its own input, against brute force."""

import zlib

import duckdb
import numpy as np
import pytest

pytest.importorskip("tidecast.llm")
corpus_pipeline = pytest.importorskip("corpus_pipeline")

import public_tokenizers
from tokenizers import Tokenizer

from tidecast.llm import bagminhash, line_dedup, pii, quality
from tidecast.llm.common import crc32_of_id

STAGES = dict(corpus_pipeline.STAGES)


def brute_scores(model, texts):
    """Votes of the nearest neighbours, one text after the other."""
    out = []
    for text in texts:
        own = quality.terms(text).astype(float) * model.weights @ model.axes
        if not own.any():
            out.append(model.prior)
            continue
        alike = [round(float(own @ v / np.linalg.norm(own)), 6) for v in model.vectors.astype(float)]
        near = sorted(range(len(alike)), key=lambda i: (-alike[i], i))[: quality.NEIGHBOURS]
        weight = np.exp(quality.SHARPNESS * (np.array(alike)[near] - alike[near[0]])) * model.balance[near]
        out.append(float((weight * model.votes[near]).sum() / weight.sum()))
    return out


def test_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = docs.toPandas()
    columns = list(before.columns)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        df = stage(spark, docs, sf_dir)
        after = df.toPandas()
        assert df.columns == columns and after.n_chars.eq(after.text.str.len()).all(), name
        text = after.set_index("doc_id").text
        if name == "quality":
            known = crc32_of_id() % 3 != 1
            model = quality.learn(docs.where(known), spark.read.parquet(f"{sf_dir}/labels.parquet").where(known))
            scores = brute_scores(model, before.text)
            sure = [abs(s - 0.5) > 0.02 for s in scores]
            assert np.mean(sure) > 0.95 and 0.5 < len(after) / len(before) < 1
            assert all((doc in text.index) == (s >= 0.5) for doc, s, ok in zip(before.doc_id, scores, sure) if ok)
        if name == "line_dedup":
            documents = before  # noqa: F841
            want = duckdb.sql(line_dedup.ORACLE_SQL).df().set_index("doc_id").text
            assert set(after.doc_id) == set(before.doc_id) and text.sort_index().equals(want.sort_index().rename("text"))
            assert text.ne(before.set_index("doc_id").text.reindex(text.index)).any()
        if name == "near_duplicates":
            bags = [bagminhash.shingle_counts(t.split()) for t in before.text]
            gone = set(before.doc_id) - set(after.doc_id)
            for i, doc in enumerate(before.doc_id):
                alike = [before.doc_id[j] for j in range(len(bags)) if j != i and bagminhash.weighted_jaccard(bags[i], bags[j]) >= 0.8]
                assert (doc in gone) <= bool(alike)
                assert not (doc not in gone and any(a not in gone for a in alike))
        if name == "pii":
            model = pii.train()
            found = pii.find_spans(before.text.tolist(), model)
            want = [pii.redact_text(t, b + a) for t, (b, a) in zip(before.text, found)]
            assert text.reindex(before.doc_id).tolist() == want
            assert not any(pii.base_spans(t) for t in after.text) and any("[EMAIL]" in t for t in after.text)
        docs, before = spark.createDataFrame(after, df.schema), after
    packed = STAGES["packing"](spark, docs, sf_dir).toPandas()
    library = Tokenizer.from_file(public_tokenizers.path(corpus_pipeline.VOCABULARY))
    assert set(packed.doc_id) == set(before.doc_id)
    for doc, text in zip(before.doc_id, before.text):
        ids = np.array([*library.encode(text, add_special_tokens=False).ids, 1], "<u4")
        own = packed[packed.doc_id == doc].sort_values("start")
        assert own.length.sum() == len(ids) and own.start.tolist() == [0, *own.length.cumsum().tolist()[:-1]]
        assert all(zlib.crc32(ids[p.start : p.start + p.length].tobytes()) == p.ids_crc32 for p in own.itertuples())
    fill = packed.groupby("sequence_id").length.sum()
    ordered = packed.sort_values(["sequence_id", "offset"])
    assert fill.max() <= 2048 and (ordered.groupby("sequence_id").length.cumsum() - ordered.length == ordered.offset).all()


ODD = [(None, None, None, None, 1.0, "a"), (None, "", "en", "x", 2.0, "b"), (1, "The same words stand here in this row, twice.", "en", "x", 3.0, "c"), (1, "The same words stand here in this row, twice.", "en", "x", 3.0, "c"), (2, "word " * 60_000, "en", None, 4.0, "d"), (3, "mail ann@site.org\n\n\n", None, "y", 5.0, "e")]
SCHEMA = "doc_id long, text string, lang string, source string, score double, places string"


@pytest.mark.parametrize("name", list(STAGES))
def test_stages_take_nulls_repeats_long_texts_and_clashing_columns(spark, sf_dir, name):
    docs = spark.createDataFrame(ODD, SCHEMA)
    got = STAGES[name](spark, docs, sf_dir).toPandas()
    if name == "packing":
        assert got.groupby("doc_id", dropna=False).length.sum().sum() > 60_000 and (got.doc_id == 1).sum() == 2
    else:
        assert list(got.columns) == ["doc_id", "text", "lang", "source", "n_chars"] and got.text.notna().all()
        if name in ("line_dedup", "pii"):
            assert len(got) == len(ODD)
        if name == "near_duplicates":
            assert sorted(got.doc_id.dropna()) == [1, 2, 3] and got.doc_id.isna().sum() == 2
    assert STAGES[name](spark, docs.limit(0), sf_dir).count() == 0


def test_run(spark, sf_dir):
    assert corpus_pipeline.run(spark, sf_dir).count() > 0
