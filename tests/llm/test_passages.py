"""Repeated passages and benchmark overlaps against plain versions."""

from __future__ import annotations

import random

import numpy as np
import plain
from fixtures import docs_of  # noqa: F401
import pytest

from basketry.llm import anchors, spaced_seeds, suffix_dedup


def passages(seed: int, n: int = 40) -> list[tuple[int, str | None]]:
    """Texts that share passages of many lengths, copies, periodic and non-ASCII text."""
    draw = random.Random(seed)
    word = lambda: "".join(draw.choice("abcdeéf") for _ in range(draw.randrange(1, 9)))
    line = lambda k: " ".join(word() for _ in range(k))
    shared = [line(k) for k in (60, 75, 90, 150, 400)] + ["ab " * 300, "x" * 500]
    docs: list[str | None] = [None, "", "short", line(40)]
    for _ in range(n):
        docs.append(" ".join(draw.choice([line(draw.randrange(1, 60)), draw.choice(shared), draw.choice(shared)[draw.randrange(80):]]) for _ in range(3)))
    return list(enumerate(docs + docs[6:9]))


@pytest.mark.parametrize("seed", [1, 2])
def test_removed_bytes_equal_marking_every_window(docs_of, seed):
    docs = passages(seed)
    got = sorted(map(tuple, suffix_dedup.report(docs_of(docs)).collect()))
    assert got == sorted(plain.removed(docs))


def test_the_edges_of_ranges_are_compared(spark, docs_of):
    """As many ranges as rows: nearly every pair of neighbours lies in two ranges."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        docs = passages(3, 8)
        assert sorted(map(tuple, suffix_dedup.report(docs_of(docs)).collect())) == sorted(plain.removed(docs))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_rows_without_ids_and_equal_rows_count_as_documents(docs_of):
    text = " ".join(f"v{i}" for i in range(200))
    got = suffix_dedup.report(docs_of([(1, text), (1, text), (None, "a" * 399), (None, text[:450])])).collect()
    assert sorted((r["n_bytes"], r["n_removed"]) for r in got) == [(399, 0), (450, 450), (len(text), len(text)), (len(text), len(text))]


def test_multikey_order_sorts_all_columns(monkeypatch):
    monkeypatch.setattr(suffix_dedup, "SMALL", 4)
    draw = np.random.default_rng(2)
    columns = [draw.integers(-3, 3, 500), draw.integers(0, 4, 500), draw.integers(0, 9, 500)]
    order = suffix_dedup.multikey_order(columns)
    rows = list(zip(*(c[order] for c in columns)))
    assert rows == sorted(rows) and sorted(order) == list(range(500))


def test_segments_cover_every_window_once(monkeypatch):
    data = " ".join(f"t{i * i % 613}" for i in range(900)).encode()
    whole = anchors.segments(data)
    assert whole.start[0] == 0 and (whole.start[1:] == (whole.start + whole.count)[:-1]).all()
    assert whole.count.sum() == len(data) - anchors.WIDTH + 1 and whole.count.max() <= anchors.WIDTH - anchors.GRAM + 1
    monkeypatch.setattr(anchors, "PASS", 100)
    cut = anchors.segments(data)
    assert set(whole.anchor) <= set(cut.anchor) and cut.count.sum() == whole.count.sum()


def test_texts_without_an_id_are_told_apart(spark, docs_of):
    """Two texts of equal 32-bit hash, both without id, one of them repeated elsewhere: the other stays."""
    from pyspark.sql import functions as F

    texts = spark.range(200_000).select(F.concat(*[F.sha2(F.concat_ws(":", F.lit(i), "id"), 256) for i in range(7)]).alias("text"))
    alike = texts.groupBy(F.hash("text")).agg(F.collect_list("text").alias("t")).where(F.size("t") > 1).first()["t"]
    docs = [(None, alike[0]), (None, alike[1]), (5, "x " + alike[0] + " y"), (None, "short")]
    got = {(r["doc_id"], r["n_bytes"], r["n_removed"]) for r in suffix_dedup.report(docs_of(docs)).collect()}
    assert got == {(None, 448, 448), (None, 448, 0), (5, 452, 448), (None, 5, 0)}


# benchmark overlaps ---------------------------------------------------------------------


@pytest.mark.parametrize("small", [True, False])
def test_overlaps_equal_the_plain_rule(spark, docs_of, monkeypatch, small):
    if not small:
        monkeypatch.setattr(spaced_seeds, "SEEDS_AT_ONCE", 0)
    draw = random.Random(4)
    line = lambda k: [f"w{draw.randrange(60)}" for _ in range(k)]
    items = [(i, line(k)) for i, k in enumerate((3, 5, 6, 9, 11, 12, 15, 30, 60, 60))]
    docs = [line(50) for _ in range(6)]
    for _, item in items:
        for changed in (0, 1, 2, 4, 9):
            copy = list(item)
            for j in draw.sample(range(len(copy)), min(changed, len(copy))):
                copy[j] = "changed"
            docs.append(line(draw.randrange(0, 9)) + copy[draw.choice([0, 0, 3]):] + line(draw.randrange(0, 9)))
    got = spaced_seeds.overlaps(
        docs_of([(i, " ".join(d).replace("w1 ", "W1, ")) for i, d in enumerate(docs)]),
        spark.createDataFrame([(i, " ".join(t)) for i, t in items], "item_id long, text string"))
    want = {(i, k): share for i, d in enumerate(docs) for k, item in items if len(item) >= 6 and (share := whole_rule(d, item)) >= spaced_seeds.LEAST}
    assert {(r["doc_id"], r["item_id"]): r["overlap"] for r in got.collect()} == want
    assert len(want) > 15
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan


@pytest.mark.parametrize("at_once", [500_000, 0])
def test_long_texts_and_items_without_an_id(spark, docs_of, monkeypatch, at_once):
    """An item far inside a text of 20,000 words; items without an id, with a repeated id, and repeated ones."""
    monkeypatch.setattr(spaced_seeds, "SEEDS_AT_ONCE", at_once)
    item = lambda k, n: " ".join(f"q{k}w{i}" for i in range(n))
    items = [(None, item(1, 40)), (None, item(2, 40)), (7, item(3, 30)), (7, item(4, 8)), (8, item(5, 12)), (8, item(5, 12))]
    lead = " ".join(f"v{i % 5003}" for i in range(20_000))
    docs = [(1, f"{lead} {item(1, 40)} {lead}"), (2, item(4, 8) + " " + lead), (3, lead), (4, item(5, 12)), (5, item(2, 40)), (6, "q3w0 q4w1 q3w2 q4w3 q3w4 q4w5 q3w6 q4w7")]
    got = spaced_seeds.overlaps(docs_of(docs), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert sorted((r["doc_id"], r["item_id"], r["overlap"], r["first_word"]) for r in got) == [(1, None, 1.0, 20_000), (2, 7, 1.0, 0), (4, 8, 1.0, 0), (5, None, 1.0, 0)]


def test_substituted_words_do_not_hide_an_item(spark, docs_of):
    item = [f"term{i}" for i in range(40)]
    doc = [w if i % 7 else "other" for i, w in enumerate(item)]
    items = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    [row] = spaced_seeds.overlaps(docs_of([(5, "lead in " + " ".join(doc)), (6, "quite another text " * 20)]), items).collect()
    assert (row["doc_id"], row["item_id"], row["first_word"]) == (5, 1, 2)


def whole_rule(doc: list[str], item: list[str]) -> float:
    """The rule without seeds: the best share of equal words of any window of the item anywhere in the document."""
    size, best = min(len(item), spaced_seeds.WINDOW), 0
    for starts in range(-len(item) + 1, len(doc)):
        same = [0 <= starts + j < len(doc) and doc[starts + j] == w for j, w in enumerate(item)]
        best = max(best, *(sum(same[k:k + size]) for k in range(len(item) - size + 1)))
    return best / size


def test_overlaps_equal_all_windows_without_seeds(spark, docs_of):
    draw = random.Random(11)
    items, docs = [], []
    for i, n in enumerate([6, 7, 9, 10, 12, 14, 15, 17, 19, 20, 23, 24, 24, 30, 60]):
        items.append((i, [f"i{i}w{j}" for j in range(n)]))
        for _ in range(12):
            at = draw.randrange(n - min(n, 24) + 1)
            copy = items[-1][1][at:at + 24]
            for j in draw.sample(range(len(copy)), draw.choice([len(copy) // 5, len(copy) // 5, len(copy) // 5 + 1])):
                copy[j] = "changed"
            docs.append(["lead"] * draw.randrange(5) + copy + ["tail"] * draw.randrange(5))
    got = spaced_seeds.overlaps(
        docs_of([(k, " ".join(d)) for k, d in enumerate(docs)]), spark.createDataFrame([(i, " ".join(t)) for i, t in items], "item_id long, text string"))
    want = {(k, i): share for k, d in enumerate(docs) for i, t in items if (share := whole_rule(d, t)) >= spaced_seeds.LEAST}
    assert {(r["doc_id"], r["item_id"]): r["overlap"] for r in got.collect()} == want
    assert 60 < len(want) < len(docs)
