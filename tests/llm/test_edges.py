"""Every operator on nulls, empty and very long texts, repeated rows, clashing columns and empty tables."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from fixtures import edge, empty  # noqa: F401
from basketry.llm import circulant, cotraining, fingerprints, language_id, licenses, pieces, pii, secrets, spaced_seeds, suffix_dedup
from basketry.llm.catalog import QUERIES, piece_model


def benchmark(spark):
    return spark.createDataFrame(
        [(1, None), (2, ""), (3, "two words"), (4, "the same words in two rows"), (5, " ".join(f"bench{i}" for i in range(30)))], "item_id long, text string")


def struct(column):
    return lambda docs: docs.select("doc_id", column(F.col("text")).alias("r")).select("doc_id", "r.*")


def quality(docs):
    labels = docs.sparkSession.createDataFrame([(3, 1), (4, 0), (5, 1), (None, 1), (6, None)], "doc_id long, quality int")
    return docs.select("doc_id", cotraining.score(cotraining.learn(docs, labels)).alias("r")).select("doc_id", "r.*")


OPERATORS = {
    "secrets": struct(secrets.report), "licenses": struct(licenses.report),
    "seeds": lambda d: spaced_seeds.overlaps(d, benchmark(d.sparkSession)), "fingerprints": fingerprints.edited_fingerprints,
    "suffixes": suffix_dedup.report, "quality": quality, "circulant": circulant.near_copies, "universal": fingerprints.near_copies,
    "language": struct(lambda text: language_id.predict(text, language_id.fit(["the words", "les mots"], ["en", "fr"]))),
    "personal": pii.report, "pieces": struct(lambda text: pieces.digest(text, piece_model())),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_edge_rows(edge, name):
    got = OPERATORS[name](edge).collect()
    if name == "seeds":  # long items match none of these; the short one is in three rows of two ids
        assert {(r["doc_id"], r["item_id"]) for r in got} == {(4, 4), (5, 4)}
    else:
        ids = lambda rows: sorted((r["doc_id"] is None, r["doc_id"]) for r in rows)
        assert ids(got) == ids(edge.select("doc_id").collect())


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(empty, name):
    assert OPERATORS[name](empty).collect() == []


def test_no_items_and_no_labels(edge, spark):
    assert spaced_seeds.overlaps(edge, benchmark(spark).limit(0)).collect() == []
    model = cotraining.learn(edge, spark.createDataFrame([], "doc_id long, quality int"))
    assert {r["r"]["score"] for r in edge.select(cotraining.score(model).alias("r")).collect()} == {0.5}


def test_near_copies_of_edge_rows(edge):
    got = {(r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in circulant.near_copies(edge).collect()}
    assert (1, 0, 1, True) in got and (2, 0, 2, True) in got and (7, 0, 7, True) in got
    assert (4, 3, 4, True) in got and (5, 3, 4, False) in got
    assert (None, 4, None, True) in got and (None, 0, None, True) in got


def test_stages_on_edge_rows(edge, empty, spark, tmp_path):
    benchmark(spark).write.parquet(str(tmp_path / "benchmark.parquet"))
    for docs in (edge, empty):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            kept = stage(spark, docs, str(tmp_path))
            assert kept.columns == docs.columns, name
            kept.collect()
        last = corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path))
        assert "text" not in last.columns and all(r["decodes"] for r in last.collect())


def test_every_operator_is_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
