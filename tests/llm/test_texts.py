"""Operators on texts against brute force, round trips and held-out accuracy."""

import hashlib
import random
import re
import zlib

import numpy as np
import pandas as pd
import pytest

pytest.importorskip("tidecast.llm")
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidecast.llm import bpe, chat, langid, packing, pii, quality, queries

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = ["", "  \n\t a  b\x85c d　  x\x1c\x1dy", "<|endoftext|>a<|endoftext|>", "é" * 300, "a" * 5000, "日本語テキスト𝒳 ½ Ⅷ ٣", "it's we'll 'S", "\x00\x01 \x7f", "<|endoftext|", "👩‍👩‍👧 ok", "ab " * 3000]


@pytest.fixture(scope="module")
def reference():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def odd_docs(spark):
    rows = [(i, t, "x", i) for i, t in enumerate(ODD)] + [(100, None, None, None), (2, ODD[2], "x", 1), (None, "no id", "y", 2)]
    return spark.createDataFrame(rows, "doc_id long, text string, ids string, length int")


def test_bpe_matches_the_library(reference):
    coder = bpe.RankArrayBPE(PATH, 50)
    texts = ODD + pd.read_parquet("/root/testdata/sf0.001/documents.parquet").text.head(40).tolist()
    for text in texts:
        ids = reference.encode(text, add_special_tokens=False).ids
        assert coder.encode(text) == ids
        assert packing.token_ids(text, PATH).tolist() == ids
        assert coder.decode(ids) == reference.decode(ids, skip_special_tokens=False) == text


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=80))
def test_bpe_round_trip(text):
    coder, library = bpe.codec(PATH), Tokenizer.from_file(PATH) if not hasattr(test_bpe_round_trip, "t") else test_bpe_round_trip.t
    test_bpe_round_trip.t = library
    ids = coder.encode(text)
    assert ids == library.encode(text, add_special_tokens=False).ids and coder.decode(ids) == text
    assert packing.token_ids(text, PATH).tolist() == ids


def test_scan_and_heap_agree():
    coder, rng = bpe.RankArrayBPE(PATH), random.Random(1)
    for _ in range(300):
        raw = bytes(rng.choice(b"theanosirl ") for _ in range(rng.randint(1, 90)))
        assert coder._scan(raw) == coder._heap(raw)


def test_bpe_query(spark, odd_docs, reference):
    got = bpe.round_trip_digests(odd_docs, PATH).toPandas()
    assert len(got) == odd_docs.count()
    for text, row in zip(odd_docs.toPandas().text, got.itertuples()):
        ids = reference.encode(text or "", add_special_tokens=False).ids
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()
    back = bpe.decode_documents(bpe.encode_documents(odd_docs, PATH), PATH).toPandas()
    assert back.text.tolist() == [t or "" for t in odd_docs.toPandas().text]


def test_best_fit_decreasing_takes_the_tightest_window():
    rng = random.Random(4)
    for _ in range(30):
        lengths = sorted((rng.randint(1, 64) for _ in range(rng.randint(0, 200))), reverse=True)
        numbers, offsets = packing.best_fit_decreasing(lengths, 64)
        room: list[int] = []
        for need, number, offset in zip(lengths, numbers, offsets):
            fits = [r for r in room if r >= need]
            if not fits:
                assert number == len(room) and offset == 0
                room.append(64)
            else:
                assert room[number] == min(fits) and offset == 64 - room[number]
            room[number] -= need


def test_packing_query(spark, sf_dir, odd_docs, reference):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").unionByName(odd_docs.selectExpr("doc_id + 1000000 as doc_id", "text").where("doc_id is not null"))
    got = packing.pack_documents(docs, PATH).toPandas()
    texts = docs.toPandas()
    counts = texts.doc_id.value_counts()
    for doc, text in zip(texts.doc_id, texts.text):
        ids = np.array([*reference.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        own = got[got.doc_id == doc].sort_values("start")
        assert (own.doc_tokens == len(ids)).all() and own.length.sum() == len(ids) * counts[doc]
        for piece in own.itertuples():
            assert zlib.crc32(ids[piece.start : piece.start + piece.length].tobytes()) == piece.ids_crc32
    ordered = got.sort_values(["sequence_id", "offset"])
    before = ordered.groupby("sequence_id").length.cumsum() - ordered.length
    assert (before == ordered.offset).all()
    fill = got.groupby("sequence_id").length.sum()
    assert fill.max() <= 2048 and got.length.sum() / (2048 * len(fill)) > 0.97
    assert packing.pack_documents(docs.limit(0), PATH).count() == 0


BASE = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")]


def brute_spans(text):
    out = []
    for kind, pattern in BASE:
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            bad = kind == "ip" and any(int(x) > 255 for x in m[0].split(".")) or kind == "phone" and not 9 <= len(digits) <= 15
            bad = bad or kind == "card" and not (13 <= len(digits) <= 19 and pii.luhn(digits))
            if not bad:
                out.append((kind, *m.span()))
    return out


@settings(max_examples=400, deadline=None)
@given(st.one_of(st.text("123.@ab+- ()0é\n", max_size=60), st.from_regex(r"\+[0-9][ ().0-9-]{8,14}[0-9] [0-9]{4}( [0-9]{4}){3} a@b\.c\.1\.2\.3\.4", fullmatch=True)))
def test_base_spans(text):
    assert pii.base_spans(text) == brute_spans(text)


def test_long_runs_stay_linear():
    for text in ("a" * 200_000, "1" * 200_000, "a@" * 50_000, "1." * 100_000, "+1" * 50_000):
        pii.base_spans(text)


def test_tagger_gradient_and_accuracy():
    model, rng = pii.CharTagger.fresh(1), np.random.default_rng(0)
    codes, tags = pii._windows(pii.labelled_texts(3, 3), rng)
    _, grads = model.gradient(codes, tags)
    for name, w in model.w.items():
        at, old = tuple(rng.integers(0, s) for s in w.shape), None
        old = w[at]
        w[at] = old + 1e-5
        high, _ = model.gradient(codes, tags)
        w[at] = old - 1e-5
        low, _ = model.gradient(codes, tags)
        w[at] = old
        assert abs((high - low) / 2e-5 - grads[name][at]) < 1e-4, name
    held = pii.labelled_texts(400, 99)
    right = wrong = missed = base_right = 0
    for (text, want), (base, added) in zip(held, pii.find_spans([t for t, _ in held], pii.train())):
        got, want = set(base + added), set(want)
        right, wrong, missed = right + len(got & want), wrong + len(got - want), missed + len(want - got)
        base_right += len(set(base) & want)
    assert right / (right + wrong) > 0.95 and right / (right + missed) > 0.75 > base_right / (right + missed)


def test_pii_query(spark, odd_docs, sf_dir):
    extra = spark.createDataFrame([(50, "mail a.b@c.example.com from 10.0.0.1, card 4539 1488 0343 6467, call +1 (415) 555-2671 " + "x" * 70_000 + " z@y.org"), (51, "call (415) 555-2671 now")], "doc_id long, text string")
    docs = odd_docs.select("doc_id", "text").unionByName(extra).unionByName(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    got, texts = pii.span_digests(docs).toPandas(), docs.toPandas().text
    for text, row in zip(texts, got.itertuples()):
        want = brute_spans(text or "")
        assert row.base_sha256 == hashlib.sha256(pii.spans_text(want).encode()).hexdigest()
        assert [row.n_email, row.n_ip, row.n_card, row.n_phone] == [sum(s[0] == k for s in want) for k in pii.KINDS]
        assert set(filter(None, pii.spans_text(want).split(","))) <= set(row.spans.split(","))
    redacted = pii.redact(extra).toPandas().text
    assert redacted[0].startswith("mail [EMAIL] from [IP], card [CARD], call [PHONE] x") and redacted[0].endswith(" [EMAIL]")
    assert redacted[1] == "call ([PHONE] now" or redacted[1] == "call [PHONE] now"
    assert pii.span_digests(docs.limit(0)).count() == 0


def test_quality_held_out(spark):
    got = queries.op7_quality(spark, "/root/testdata/sf0.1").toPandas()
    labels = pd.read_parquet("/root/testdata/sf0.1/labels.parquet")
    both = got[got.held_out].merge(labels, on="doc_id")
    assert (both.predicted == both.quality).mean() > 0.97 and both[both.quality == 1].predicted.mean() > 0.98
    assert got.score.between(0, 1).all() and len(got) == 10_000


def test_quality_edges(spark, odd_docs):
    labels = spark.createDataFrame([(0, 1, 0), (3, 0, 0), (4, None, 0), (5, 7, 0), (3, 0, 1), (None, 1, 1), (6, 1, 0)], "doc_id long, quality int, score int")
    model = quality.learn(odd_docs, labels)
    assert quality.score(odd_docs, model).count() == odd_docs.count()
    empty = quality.learn(odd_docs, labels.limit(0))
    assert quality.score(odd_docs, empty).toPandas().score.eq(0.5).all()


def test_language_held_out(spark):
    got = queries.op10_langid(spark, "/root/testdata/sf0.1").toPandas()
    truth = pd.read_parquet("/root/testdata/sf0.1/documents.parquet")[["doc_id", "lang"]]
    both = got[got.held_out].merge(truth, on="doc_id")
    assert (both.lang_pred == both.lang).mean() > 0.97 and got.score.between(0, 1).all()


def test_language_edges(spark):
    rows = [(i, "der die das und nicht ein" if i % 2 else "the of and to in that", "de" if i % 2 else "en", "x") for i in range(40)]
    docs = spark.createDataFrame(rows + [(50, None, "en", ""), (51, "", None, ""), (52, "12 34 !", "de", ""), (None, "the and", "en", "")], "doc_id long, text string, lang string, gram string")
    model = langid.learn(docs)
    got = langid.identify(docs, model).toPandas().set_index("doc_id")
    assert got.lang_pred[[50, 51, 52]].tolist() == ["und"] * 3 and got.lang_pred[1] == "de" and got.lang_pred[2] == "en"
    nothing = langid.learn(docs.limit(0))
    assert set(langid.identify(docs, nothing).toPandas().lang_pred) == {"und"}


def test_every_language_is_learned(spark, monkeypatch):
    names = [chr(97 + i // 26) + chr(97 + i % 26) for i in range(70)]
    rows = [(i * 10 + k, f"{x}{x}q {x}z{x} {x}{x}{x}", x) for i, x in enumerate(names) for k in range(3 if i < 69 else 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.learn(docs)
    assert model.languages == names
    got = langid.identify(docs, model).toPandas().set_index("doc_id").lang_pred
    assert all(got[i] == x for i, _, x in rows)
    monkeypatch.setattr(langid, "MAX_GRAMS", 5)
    many = [(i, "abcdefghijklmnop", "big") for i in range(20)] + [(100, "xyz", "rare")]
    small = langid.learn(spark.createDataFrame(many, "doc_id long, text string, lang string"))
    assert small.predict("xyz")[0] == "rare"


def test_bloom_masks_hold_every_gram():
    rng = np.random.default_rng(1)
    grams = {x: rng.integers(0, 2**63, 3000).astype(np.uint64) for x in "abcdefghijk"}
    model = langid.BitSlicedFilter.build(grams, 1 << 14)
    for bit, x in enumerate(sorted(grams)):
        assert ((model.masks(grams[x]) >> np.uint64(bit)) & np.uint64(1)).all()
    strange = rng.integers(0, 2**63, 40_000).astype(np.uint64)
    assert np.allclose(model.counts(model.masks(strange)) / 40_000, model.false_rate, atol=0.02)


TURNS = [("user", "\\### Assistant: </turn> ok"), ("assistant", "\\### Assistant: </turn> ok"), ("weird: x\n###", "a\\"), ("", ""), ("assistant", "####\\\\</turn>\n### User:\n</turn>\n\\"), ("User", "x"), ("=a", "</turn")]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.sampled_from(["user", "assistant"]), st.text("=#:\\n;</turn>\n aU", max_size=12)), st.text("\\#</turn>\n:aA ", max_size=40)), max_size=5))
def test_chat_reads_back(turns):
    messages = [{"role": r, "text": t} for r, t in turns]
    reader, template = chat.TurnReader(), chat.compiled(chat.TEMPLATE)
    got = [x for text, masked in template.stream(messages=iter(messages)) for x in reader.feed(text, masked)]
    assert [(r, t) for r, t, _ in got] == turns and [x for *_, x in got] == [t if r == "assistant" else "" for r, t in turns]
    text, spans = template.render(messages=messages)
    assert "".join(chat.unescape(text[a:b]) for a, b in spans) == "".join(t for r, t in turns if r == "assistant")


def test_template_language():
    t = chat.Template("a{{ 'b' ~ 1 }}{% if true %}c{% elif x %}d{% endif %}{% set q = y.z %}{{q|upper}}{% for i in L %}{{loop.index}}{{i}}{% if not loop.last %},{% endif %}{% endfor %}")
    assert t.nodes[0] == ("text", "ab1c")
    assert t.render(y={"z": "q"}, L=["p", "r"])[0] == "ab1cQ1p,2r"
    for bad in ("{{ a.b() }}", "{{ a|exec }}", "{% for %}", "{% if a %}", "{{ 'a }}", "{% import os %}"):
        with pytest.raises(chat.TemplateError):
            chat.Template(bad)
    assert chat.Template("{{ a.__class__ }}").render(a="x")[0] == ""


def test_chat_query(spark):
    rows = [(9, i, r, t) for i, (r, t) in enumerate(TURNS)] + [(1, 1, "assistant", None), (1, 0, None, "hé"), (1, 1, "assistant", None), (2, None, "user", "x"), (None, 0, "user", "y")]
    df = spark.createDataFrame([(*r, "z") for r in rows], "conv_id long, turn long, role string, text string, formatted string")
    got = chat.format_digests(df).toPandas()
    whole = chat.format_conversations(df).toPandas()
    key = lambda x: (x is not None, x or 0)
    for conv in {r[0] for r in rows}:
        mine = got[got.conv_id.isna() if conv is None else got.conv_id == conv].iloc[0]
        text = whole[whole.conv_id.isna() if conv is None else whole.conv_id == conv].iloc[0]
        turns = sorted((r[1:] for r in rows if r[0] == conv), key=lambda r: tuple(key(x) if not isinstance(x, str) else (True, x) for x in r))
        turns = [(r or "", t or "") for _, r, t in turns]
        loss = "".join(t for r, t in turns if r == "assistant")
        assert mine.n_turns == len(turns) and mine.loss_chars == len(loss) and mine.formatted_chars == len(text.formatted)
        assert mine.turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
        assert mine.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
    assert chat.format_digests(df.limit(0)).count() == 0


def test_chat_registered(spark, sf_dir):
    got = queries.op9_chat(spark, sf_dir).toPandas()
    assert (got.conv_id == -7).sum() == 1 and got[got.conv_id == -7].n_turns.tolist() == [2]


def test_registered_texts_run(spark, sf_dir):
    for name in ("op2_packing", "op3_pii", "op8_bpe"):
        assert queries.queries()[name](spark, sf_dir).count() > 0


def test_packing_long_blanks_and_repeated_rows(spark, reference):
    blank = "a" + " \n" * 60_000 + " b" + " " * 40_000
    assert packing.token_ids(blank, PATH).tolist() == reference.encode(blank, add_special_tokens=False).ids
    assert len(packing.token_ids(" " * 2_000_000, PATH))
    docs = spark.createDataFrame([(1, "the same text")] * 3_000, "doc_id long, text string").coalesce(1)
    pieces = packing.cut_documents(docs, PATH)
    got = packing.pack_pieces(pieces, shard_pieces=100).toPandas()
    assert len(got) == 3_000 and (got.sequence_id % 30).nunique() > 20
    assert (got.sort_values(["sequence_id", "offset"]).groupby("sequence_id").length.cumsum() <= 2048).all()


def test_grams_of_parts_are_those_of_the_text():
    rng = random.Random(3)
    for _ in range(200):
        text = "".join(rng.choice("abé 1.Ж𝒳") for _ in range(rng.randint(0, 40)))
        padded, want = [0, *langid._codes(text).tolist(), 0], 0
        for n in langid.SIZES:
            for i in range(len(padded) - n + 1):
                gram = padded[i : i + n]
                want += all(gram[1:-1]) and any(gram) if n > 1 else bool(gram[0])
        whole = np.sort(langid.gram_hashes(text))
        assert len(whole) == want
        for part in (1, 2, 3, 7):
            assert np.array_equal(np.sort(np.concatenate(list(langid.gram_parts(text, part)))), whole)


def test_no_letter_is_und(spark):
    rows = [(i, "der Hund und die Katze" if i % 2 else "the dog and the cat", "de" if i % 2 else "en") for i in range(60)]
    model = langid.learn(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    odd = ["\u00b2\u00bd", "\u2460", "\u2167", "123 _", "", None]
    got = langid.identify(spark.createDataFrame([(i, t, "x", 1.0) for i, t in enumerate(odd)], "doc_id long, text string, lang_pred string, score double"), model).toPandas()
    assert set(got.lang_pred) == {"und"} and (got.score == 0).all()
    assert langid.identify(spark.createDataFrame([], "doc_id long, text string"), model).count() == 0


def test_langid_matches_brute_force(spark, sf_dir):
    """Sets of n-grams in place of Bloom filters: the same language wherever the two
    highest shares of hits differ by more than the filters' false positives."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = langid.learn(docs.where("doc_id % 5 <> 0"))
    all_rows = docs.toPandas()
    known = all_rows[(all_rows.doc_id % 5 != 0) & all_rows.lang.notna() & all_rows.text.notna()]
    grams = {}
    for lang, texts in known.groupby("lang").text:
        found, n = np.unique(np.concatenate([np.unique(langid.gram_hashes(t)) for t in texts]), return_counts=True)
        grams[lang] = set(found[n >= langid.MIN_SHARE * len(texts)].tolist())
    assert model.languages == sorted(grams)
    got = langid.identify(docs, model).toPandas().set_index("doc_id").lang_pred
    compared = 0
    for doc, text in zip(all_rows.doc_id, all_rows.text):
        if not text or not any(map(str.isalpha, text)):
            assert got[doc] == "und"
            continue
        own = langid.gram_hashes(text).tolist()
        shares = {lang: sum(g in s for g in own) / len(own) for lang, s in grams.items()}
        first, second = sorted(shares.values(), reverse=True)[:2]
        if first - second > 0.02:
            compared += 1
            assert got[doc] == max(shares, key=shares.get), doc
    assert compared > 0.9 * len(all_rows)


def test_quality_matches_brute_force(spark, sf_dir):
    """Every cosine in double precision, neighbours sorted by similarity and place."""
    docs, labels = spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality.learn(docs.where("doc_id % 3 <> 1"), labels.where("doc_id % 3 <> 1"))
    assert len(model.vectors) > quality.NEIGHBOURS and np.allclose((model.vectors**2).sum(1), 1, atol=1e-4)
    got = quality.score(docs.select("doc_id", "text"), model).toPandas().set_index("doc_id").score
    for doc, text in docs.select("doc_id", "text").toPandas().itertuples(index=False):
        own = quality.terms(text).astype(float) * model.weights @ model.axes
        if not own.any():
            assert got[doc] == model.prior
            continue
        alike = [round(float(own @ v / np.linalg.norm(own)), 6) for v in model.vectors.astype(float)]
        near = sorted(range(len(alike)), key=lambda i: (-alike[i], i))[: quality.NEIGHBOURS]
        weight = np.exp(quality.SHARPNESS * (np.array(alike)[near] - alike[near[0]])) * model.balance[near]
        assert abs(got[doc] - (weight * model.votes[near]).sum() / weight.sum()) < 0.02


def test_quality_ties_and_clashing_columns(spark):
    text = "Some words that stand here. " * 3
    docs = spark.createDataFrame([(i, text, 7.0, "x") for i in range(60)], "doc_id long, text string, score double, lang string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, quality int")
    model = quality.learn(docs, labels)
    got = quality.score(docs, model, ("score", "lang")).toPandas()
    assert list(got.columns) == ["doc_id", "score", "lang"] and got.score.nunique() == 1
    first = model.votes[: quality.NEIGHBOURS]
    assert abs(got.score[0] - first.mean()) < 1e-6
    assert quality.score(docs.limit(0), model).count() == 0


def test_added_spans_match_brute_force():
    """Windows, blending and Viterbi one by one in double loops give the same spans."""
    model, half = pii.train(), pii.WINDOW // 2
    texts = [t for t, _ in pii.labelled_texts(25, 5)] + ["no mark at all", "", "4 5 " * 30, "call (212) 555-0199 or mail ann [at] site [dot] org now"]
    for text, (base, added) in zip(texts, pii.find_spans(texts, model)):
        marks = [m.start() for m in re.finditer(pii._MARKS, text)]
        starts = [s for s in range(0, max(1, len(text)), half) if any(s <= m < s + pii.WINDOW for m in marks)]
        covered = np.zeros(len(text), bool)
        total, weight = np.zeros((len(text), pii.TAGS)), np.full((len(text), 1), 1e-6)
        for s in starts:
            codes = np.zeros((1, pii.WINDOW), np.int64)
            own = pii.char_codes(text[s : s + pii.WINDOW])
            codes[0, : len(own)] = own
            e = model.emissions(codes)[0]
            for i in range(len(own)):
                near = 1 - abs(i - (pii.WINDOW - 1) / 2) / (pii.WINDOW / 2 + 1)
                total[s + i] += e[i] * near
                weight[s + i] += near
                covered[s + i] = True
        want, at = [], 0
        while at < len(text):
            if not covered[at]:
                at += 1
                continue
            end = at
            while end < len(text) and covered[end]:
                end += 1
            scores = total[at:end] / weight[at:end]
            best, back = scores[0] + model.w["first"], []
            for t in range(1, len(scores)):
                step = best[:, None] + model.w["crf"]
                back.append(step.argmax(0))
                best = step.max(0) + scores[t]
            tags = [int(best.argmax())]
            for b in reversed(back):
                tags.append(int(b[tags[-1]]))
            tags = tags[::-1]
            i = 0
            while i < len(tags):
                if not tags[i]:
                    i += 1
                    continue
                kind, j = (tags[i] - 1) // 2, i + 1
                while j < len(tags) and tags[j] == 2 + 2 * kind:
                    j += 1
                a, b = at + i, at + j
                while b > a and text[b - 1] in " \n.,-":
                    b -= 1
                if b > a and pii._valid(pii.KINDS[kind], text[a:b], text[a - 1 : a], text[b : b + 1]) and not any(a < y and x < b for _, x, y in base):
                    want.append((pii.KINDS[kind], a, b))
                i = j
            at = end
        assert added == want, text


def test_long_stretches_are_decoded_in_parts(monkeypatch):
    model = pii.train()
    text = "".join(f"id {i} and 2{i % 10}5 555 01{i % 90 + 10} or " for i in range(400)) + "call (212) 555-0199 now"
    whole = pii.find_spans([text], model)
    monkeypatch.setattr(pii, "PART", 4 * pii.WINDOW)
    assert pii.find_spans([text], model) == whole and whole[0][1]


def test_redact_with_clashing_columns(spark):
    docs = spark.createDataFrame([(1, "mail a@b.org now", "x", 3)], "doc_id long, text string, TEXT2 string, spans int")
    assert pii.redact(docs, ("TEXT2", "spans", "text")).toPandas().iloc[0].tolist() == [1, "mail [EMAIL] now", "x", 3]
