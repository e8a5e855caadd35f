"""Language identification, quality and personal data."""

from __future__ import annotations

import os
import random
from collections import Counter

import numpy as np
import plain
from fixtures import docs_of  # noqa: F401
import pytest
from pyspark.sql import functions as F

from basketry.llm import catalog, cotraining, language_id, pii

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01").replace("sf0.001", "sf0.01")
tables = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


# language -------------------------------------------------------------------------------


@tables
def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    got = catalog.op8_language_id(spark, SF).join(docs, "doc_id").where("held_out")
    right, n = got.agg(F.count_if(F.col("lang") == F.col("lang_pred")), F.count("*")).first()
    assert n > 150 and right / n >= 0.97
    assert got.where("score < 0 OR score > 1").count() == 0


def test_codewords_are_far_apart():
    for n in (2, 3, 4, 7, 12):
        code = language_id.codewords(n)
        apart = min(int((code[i] != code[j]).sum()) for i in range(n) for j in range(i))
        assert set(np.unique(code)) <= {-1, 1} and apart >= code.shape[1] // 3
    assert language_id.codewords(4).shape == (4, 7)


def test_texts_without_letters_are_undetermined(docs_of):
    model = language_id.fit(["the cat and the dog"] * 3 + ["le chat et le chien"] * 3, ["en"] * 3 + ["fr"] * 3)
    rows = docs_of([(1, None), (2, ""), (3, "12 34 _!"), (4, "le chien"), (5, "the dog")])
    got = {r["doc_id"]: r["p"] for r in rows.select("doc_id", language_id.predict(F.col("text"), model).alias("p")).collect()}
    assert [got[i]["lang_pred"] for i in (1, 2, 3, 4, 5)] == ["und", "und", "und", "fr", "en"]
    assert got[1]["score"] == 0.0 and not got[1]["ambiguous"]


def test_nothing_and_one_language_to_learn(docs_of):
    for model, want in ((language_id.fit([], []), "und"), (language_id.fit(["x y"], ["en"]), "en")):
        [row] = docs_of([(1, "some text")]).select(language_id.predict(F.col("text"), model).alias("p")).collect()
        assert row["p"]["lang_pred"] == want


def test_a_mixture_is_ambiguous():
    draw = random.Random(1)
    english, french = ([" ".join(draw.choice(words) for _ in range(40)) for _ in range(60)] for words in (
        ["the", "thing", "with", "which", "shown"], ["les", "queue", "eau", "deux", "voix"]))
    model = language_id.fit(english + french, ["en"] * 60 + ["fr"] * 60)
    best, top, second = model.decode(np.stack([language_id.ngrams(t) for t in (english[0], english[1] + " " + french[1])]))
    assert top[0] > 0.9 and top[1] < top[0] and abs(top[1] + second[1] - 1) < 1e-5


# quality --------------------------------------------------------------------------------


@tables
def test_quality_of_documents_not_learnt_from(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    test = F.col("doc_id") % 4 == 1
    model = cotraining.learn(docs, labels.where(~test))
    scored = docs.where(test).select("doc_id", cotraining.score(model).alias("r")).join(labels, "doc_id").collect()
    assert len(scored) > 60
    assert np.mean([r["r"]["keep"] == (r["quality"] == 1) for r in scored]) >= 0.95
    assert all(0 <= r["r"][c] <= 1 for r in scored for c in ("text_score", "meta_score", "score"))


def test_views_teach_each_other():
    """Few labels, a pool in which the views agree: exchange must not be worse than either alone."""
    draw = np.random.default_rng(3)
    y = np.array([0, 1] * 6, float)
    make = lambda t, noise: (t[:, None] * 2 - 1) * np.array([1.0, 0.5, 0]) + draw.normal(0, noise, (len(t), 3))
    hidden = draw.integers(0, 2, 600).astype(float)
    views = [(make(y, 0.6).astype(np.float32), make(hidden, 0.6).astype(np.float32)) for _ in range(2)]
    models = cotraining.exchange(views, y)
    for model, (_, pool) in zip(models, views):
        assert ((model.logit(pool) > 0) == (hidden > 0)).mean() > 0.88


def test_every_unlabelled_document_may_get_a_pseudo_label(spark, monkeypatch):
    """Pseudo-labels grow with the pool, rare sources get theirs, and tables give what memory gives."""
    made = []
    table = cotraining.Table
    monkeypatch.setattr(cotraining, "Table", lambda rows: made.append(table(rows)) or made[-1])
    good, bad = "the plain words of a good text number {} follow. ", "zz$$ {} 0x77 ## "
    rows = [(i, (good, bad)[i % 2].format(i) * 3, "en", ("a", "b")[i % 2], 40 + i % 2 * 900) for i in range(9000)]
    rows += [(None, good.format(i) * 3, "xx", "rare", 40) for i in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    cotraining.learn(docs, spark.createDataFrame([(i, 1 - i % 2) for i in range(400)], "doc_id long, quality int"))
    [pool] = made
    assert pool.rows.count() == 8603
    n = pool.pseudo.where("for_text >= 0").count()
    assert n >= 4 * int(0.05 * 8603) * 0.9  # of a pool of 4000 it was 800 at most
    x = [np.stack([np.frombuffer(r[v], np.float16) for r in pool.rows.collect()]).astype(np.float32) for v in ("text", "meta")]
    block = cotraining.Block(x)
    for a, b in zip(pool.moments(), block.moments()):
        assert a[0] == b[0] and np.allclose(a[1], b[1]) and np.allclose(a[2], b[2])
    models = [cotraining.Linear(np.zeros(w), np.ones(w), np.linspace(-9, 9, w), 0.1) for w in cotraining.WIDTHS]
    assert sorted(pool.surest([], models)) == sorted(block.surest([], models))


# personal data --------------------------------------------------------------------------


BITS = ["a", "1", "12", "255", "256", ".", ".", "-", " ", "  ", "@", "@", "+1", "(", ")", "x", "_", "%", "é", "😀", "\x01", "\n",
        "4111111111111111", "a@b.c", "1.2.3.4", "9807915762804490"]


def test_base_spans_equal_the_plain_patterns(docs_of):
    draw = random.Random(8)
    docs = [(i, "".join(draw.choice(BITS) for _ in range(draw.randrange(14)))) for i in range(1500)]
    docs += [(9001, None), (9002, "1 " * 20_000), (9003, "+1" + " " * 20_000 + "2345678901"), (9004, "same@host.org"), (9004, "same@host.org"), (None, "a@b.co")]
    got = pii.report(docs_of(docs)).collect()
    row = lambda i, t: (i, tuple(plain.personal(t)[0]), plain.sha(plain.personal(t)[1]))
    assert Counter((r["doc_id"], (r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]), r["base_sha256"]) for r in got) == Counter(row(*d) for d in docs)


@pytest.mark.parametrize("text,spans", [
    ("1" * 100_000, ""), ("a" * 100_000, ""), ("a." * 40_000 + "@b.c", "email:0:80004"), ("x@" + "b." * 40_000 + "c", "email:0:80003")],
    ids=["digits", "letters", "local part", "domain"])
def test_long_runs_need_neither_stack_nor_time(docs_of, text, spans):
    assert pii.report(docs_of([(1, text)])).first()["spans"] == spans


def test_contexts_of_known_entities_find_unseen_ones(docs_of):
    docs = [(i, f"hello my badge holder: user{i}@mail.com and more") for i in range(5)]
    docs += [(10, "so my badge holder: ZZ-99887 thing"), (11, "the number 12345 is plain"), (12, "write to user7@mail.com")]
    got = {r["doc_id"]: r["spans"] for r in pii.report(docs_of(docs)).collect()}
    assert got[10] == "ctx:20:28" and got[11] == "" and got[0] == "email:23:37"


def test_copies_of_the_corpus_change_no_span(docs_of):
    """Other ids, the same rows again, and an entity that stands in many documents."""
    docs = [(i, f"hello my badge holder: user{i}@mail.com and more") for i in range(5)] + [(10, "so my badge holder: ZZ-99887 thing")]
    once = {r["doc_id"]: r["spans"] for r in pii.report(docs_of(docs)).collect()}
    assert once[10] == "ctx:20:28"
    for more in ([(i + 100 * k, t) for k in range(1, 4) for i, t in docs], docs, [(i, docs[0][1]) for i in range(200, 230)]):
        for r in pii.report(docs_of(docs + more)).collect():
            assert r["spans"] == once[0 if r["doc_id"] >= 200 and len(more) == 30 else r["doc_id"] % 100]


@pytest.mark.parametrize("words", ["Donaudampfschifffahrtsgesellschaft:", "kunden " + "Lang" * 30 + " ", "工号" * 20 + " ", "İ" + "x" * 90 + ":"])
def test_long_words_are_patterns(docs_of, words):
    docs = [(i, f"see {words} user{i}@mail.com and more") for i in range(5)] + [(10, f"so {words} ZZ-99887 thing")]
    assert pii.report(docs_of(docs)).where("doc_id = 10").first()["n_ctx"] == 1


def test_scores_follow_the_graph_over_rounds(spark):
    """A pattern that only newly found instances support counts in the next round."""
    edges = [("p", f"s{i}", True) for i in range(4)] + [("p", f"n{i}", False) for i in range(4)] + [("q", f"n{i}", False) for i in range(4)]
    edges += [("of", "s0", True), ("of", "x", False)]
    totals = [("p", 8), ("q", 5), ("of", 1000)]
    sure = pii.score_patterns(
        spark.createDataFrame(edges, "pattern string, instance string, seed boolean"), spark.createDataFrame(totals, "pattern string, total long"))
    found = {r["pattern"]: r["score"] for r in sure.collect()}
    assert set(found) == {"p"} or set(found) == {"p", "q"}
    assert found["p"] >= 0.5 and "of" not in found


def test_no_python_runs_for_personal_data(docs_of):
    plan = pii.matches(docs_of([(1, "a@b.co")]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
