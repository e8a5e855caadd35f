"""Near-duplicates, fingerprints and components against plain versions."""

from __future__ import annotations

import os
import random

import numpy as np
import plain
from fixtures import docs_of  # noqa: F401
import pytest

from basketry.llm import catalog, circulant, fingerprints, neardup
from basketry.llm.components import PART, connected
from basketry.llm.neardup import Likeness
from basketry.llm.tokens import SPACES, byte_table, shingles, word_hashes


def copies(seed: int, groups: int = 12, size: int = 9) -> list[tuple[int, str | None]]:
    """Groups of texts that differ in some words each, exact copies, short and empty texts."""
    draw = random.Random(seed)
    docs: list[str | None] = [None, "", "one", "one", "Two words", "two WORDS", "a b c", "\t"]
    for g in range(groups):
        base = [f"w{draw.randrange(400)}" for _ in range(draw.randrange(8, 120))]
        for _ in range(draw.randrange(1, size)):
            text = list(base)
            for _ in range(draw.randrange(0, 4)):
                text[draw.randrange(len(text))] = f"x{draw.randrange(10**6)}"
            docs += [" ".join(text)] * draw.randrange(1, 3)
    draw.shuffle(docs)
    return [(i * 3 + 5, t) for i, t in enumerate(docs)]


@pytest.mark.parametrize("k,percent", [(3, 85), (5, 80)])
@pytest.mark.parametrize("operator", [circulant.near_copies, fingerprints.near_copies])
def test_groups_equal_all_pairs(docs_of, operator, k, percent):
    docs = copies(k)
    want = plain.components(docs, k, percent)
    got = operator(docs_of(docs), Likeness(k, percent)).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == want
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="no test tables")
def test_registered_query_equals_its_sql(spark):
    duckdb = pytest.importorskip("duckdb")
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    want = sorted(con.execute(catalog.SQL["op7_circulant_minhash"]).fetchall())
    assert sorted(map(tuple, catalog.op7_circulant_minhash(spark, sf).collect())) == want


def test_a_chain_of_links_needs_several_pivots(docs_of):
    """Neighbours are alike, ends are not: the first pivot links only its neighbours."""
    words = [f"v{i}" for i in range(400)]
    docs = [(100 - i, " ".join(words[i * 8:i * 8 + 100])) for i in range(30)]
    want = plain.components(docs, 3, 80)
    got = circulant.near_copies(docs_of(docs), Likeness(3, 80)).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == want
    assert len({c for _, c in want.values()}) == 1


def test_large_buckets_equal_all_pairs(docs_of, monkeypatch):
    """Every bucket is large: centres, profile groups and shared shingles outside of the centre do the work."""
    monkeypatch.setattr(neardup, "SMALL", 6)
    draw, docs = random.Random(11), []
    for _ in range(2):
        base = [f"b{draw.randrange(900)}" for _ in range(90)]
        extra = [f"e{draw.randrange(900)}" for _ in range(12)]
        for _ in range(24):
            text = list(base)
            for _ in range(draw.randrange(0, 7)):
                text[draw.randrange(len(text))] = draw.choice([f"x{draw.randrange(10**6)}", "same"])
            cut = draw.randrange(0, 6)
            docs.append(" ".join((extra if draw.random() < 0.4 else []) + text[cut:]))
    rows = [(i, t) for i, t in enumerate(docs)]
    want = plain.components(rows, 3, 85)
    got = circulant.near_copies(docs_of(rows), Likeness(3, 85)).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == want
    assert 2 < len({c for _, c in want.values()}) < 48


def test_centres_that_meet_the_same_members_are_one(docs_of, monkeypatch):
    """Members of many large buckets are held against few centres, not against one of every bucket."""
    monkeypatch.setattr(neardup, "SMALL", 6)
    draw, made = random.Random(4), []
    base = [f"b{i}" for i in range(100)]
    rows = []
    for i in range(80):
        text = list(base)
        for _ in range(draw.randrange(1, 9)):
            text[draw.randrange(100)] = f"x{draw.randrange(10**6)}"
        rows.append((i, " ".join(text)))
    real = neardup._Links.profiles
    monkeypatch.setattr(neardup._Links, "profiles", lambda self, pairs: made.append(pairs.count()) or real(self, pairs))
    got = circulant.near_copies(docs_of(rows), Likeness(3, 85)).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == plain.components(rows, 3, 85)
    assert 0 < made[0] < 160


def test_frequent_shingles_outside_of_a_centre_bring_nobody_together(spark):
    """Each member has 60 shingles outside of the centre: 47 that one other has too, one that all have."""
    rows = [(0, b, 100, 40, [7, *range(1000 * b + 100, 1000 * b + 112), *range(10**6 + b // 2 * 47, 10**6 + b // 2 * 47 + 47)], 70) for b in range(70)]
    got = neardup._own_buckets(spark.createDataFrame(rows, "a long, b long, n long, common long, own array<long>, around long"), 50)
    counts = {}
    for r in got.collect():
        counts.setdefault(r["bucket"], set()).add(r["node"])
    assert {frozenset(c) for c in counts.values() if len(c) > 1} == {frozenset((2 * i, 2 * i + 1)) for i in range(35)}
    assert sum(map(len, counts.values())) == 70 * 51


def test_bands_miss_almost_nothing_at_the_threshold():
    for like in (Likeness(3, 85), Likeness()):
        rows, bands = like.shape
        assert (1 - (like.percent / 100) ** rows) ** bands <= neardup.MISS and rows * bands <= 200


@pytest.mark.parametrize("signer", [circulant.signatures, fingerprints.signatures])
def test_signatures_estimate_the_similarity(signer):
    draw, errors = np.random.default_rng(5), []
    for _ in range(100):
        both, rest = draw.integers(0, 1 << 63, 160, dtype=np.uint64), draw.integers(0, 1 << 63, 80, dtype=np.uint64)
        a, b = np.concatenate([both, rest[:40]]), np.concatenate([both, rest[40:]])
        x, y = signer(np.concatenate([a, b]), np.array([0, 200, 400]), 160)
        errors.append((x == y).mean() - 160 / 240)
    assert abs(np.mean(errors)) < 0.012 and np.std(errors) < 0.05


def test_signatures_are_compared_once(spark):
    rows = spark.createDataFrame([(1, 2, b"ab", b"ab"), (1, 3, b"ab", b"cd")], "a long, b long, x binary, y binary")
    near = rows.select("a", "b", neardup._agreement(rows.x, rows.y).alias("est")).where("est >= 0.5")
    plan = near._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1
    assert list(map(tuple, near.collect())) == [(1, 2, 1.0)]


def test_words_and_shingles_of_blocks_equal_whole_texts():
    texts = [t.encode() for _, t in copies(9) if t] + [b"", b" a", ("é" * 300 + " b").encode()]
    table = byte_table(SPACES)
    words, offsets = word_hashes(texts, table)
    small, same = word_hashes(texts, table, block=7)
    assert (words == small).all() and (offsets == same).all()
    _, ends = shingles(words, offsets, 3)
    assert list(np.diff(ends)) == [max(len(t.split()) - 2, min(1, len(t.split()))) for t in texts]


@pytest.mark.parametrize("part", [9, PART])
@pytest.mark.parametrize("edges", [
    [(i, i + 1) for i in range(40)], [(0, i) for i in range(1, 30)], [(i % 17, (i * 7) % 53) for i in range(60)], [(1, 1), (2, None)], []])
def test_components(spark, edges, part):
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if b is not None:
            a, b = sorted((root(a), root(b)))
            parent[b] = a
    want = {x: root(x) for x in parent if root(x) != x}
    assert dict(map(tuple, connected(spark.createDataFrame(edges, "u long, v long"), part).collect())) == want


# fingerprints ---------------------------------------------------------------------------


@pytest.mark.parametrize("per_range", [1, 7, 500])
def test_edited_texts_meet_the_next_document(docs_of, monkeypatch, per_range):
    monkeypatch.setattr(fingerprints, "RANGE", per_range)
    docs = copies(3)
    order = sorted(docs, reverse=True)
    got = {r["doc_id"]: r for r in fingerprints.edited_fingerprints(docs_of(docs)).collect()}
    assert len(got) == len(docs)
    for (i, text), (_, following) in zip(order, order[1:] + order[:1]):
        text, following, row = text or "", following or "", got[i]
        half = len(text) // 2
        edit = text[:len(text) - half] + following[:half]
        own, other, after = fingerprints.fingerprints([text, edit, following])
        assert (row["n_chars"], row["edited_sha256"], row["fingerprint"], row["edited_fingerprint"]) == (len(text), plain.sha(edit), own, other)
        assert row["near_edited"] == fingerprints.likeness(own, other) and row["near_next"] == fingerprints.likeness(own, after)


def test_one_document_follows_itself(docs_of):
    [row] = fingerprints.edited_fingerprints(docs_of([(1, "abcdef")])).collect()
    assert row["edited_sha256"] == plain.sha("abcabc") and row["near_next"] == 1.0


def test_likeness_of_empty_fingerprints():
    own, none = fingerprints.fingerprints(["a text of some words", " "])
    assert none == "" and fingerprints.likeness("", "") == 1.0 and fingerprints.likeness(own, "") == 0.0 and fingerprints.likeness(own, own) == 1.0
