"""Registered queries of this package, each an operator over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.llm import (
    circulant, cotraining, fingerprints, language_id, licenses, packing, pieces, pii, secrets, spaced_seeds, spellings, suffix_dedup, vector_codes)
from basketry.llm.common import documents
from basketry.llm.neardup import Likeness

Query = Callable[[SparkSession, str], DataFrame]


def piece_model() -> str:
    """The vocabulary file; a path that every executor has."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def word_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _columns(docs: DataFrame, report) -> DataFrame:
    """doc_id with the fields of a struct computed from the text."""
    return docs.select("doc_id", report(F.col("text")).alias("r")).select("doc_id", "r.*")


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _columns(documents(spark, sf_dir), secrets.report)


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _columns(documents(spark, sf_dir), licenses.report)


def op3_spaced_seed_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spaced_seeds.overlaps(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited_fingerprints(documents(spark, sf_dir))


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.report(documents(spark, sf_dir))


def op6_quality_cotraining(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = cotraining.learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return docs.select("doc_id", cotraining.score(model).alias("r")).select("doc_id", "r.*")


def op7_circulant_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return circulant.near_copies(documents(spark, sf_dir), Likeness(shingle=3, percent=85))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = language_id.learn(docs)
    found = docs.select("doc_id", language_id.predict(F.col("text"), model).alias("r"))
    return found.select("doc_id", language_id.held_out(F.col("doc_id")).alias("held_out"), "r.*")


def op9_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(documents(spark, sf_dir))


def op10_piece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _columns(documents(spark, sf_dir), lambda text: pieces.digest(text, piece_model()))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.report(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spellings.variants(documents(spark, sf_dir))


def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pieces(documents(spark, sf_dir), word_model())


QUERIES: dict[str, Query] = {f.__name__: f for f in (
    op1_secret_scan, op2_license_scan, op3_spaced_seed_decontamination, op4_fingerprints, op5_suffix_dedup, op6_quality_cotraining, op7_circulant_minhash, op8_language_id, op9_personal_data, op10_piece_codec,
    op11_vector_codes, op12_spelling_variants, op13_packing,
)}

#: DuckDB SQL for the queries that SQL can express: all pairs by shared shingles, groups by reachability.
_NEAR_COPIES = """WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\\x20\\x09-\\x0D]+'), lambda v: v <> '') AS w FROM documents),
sets AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
  ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' '))) END AS s FROM words),
items AS (SELECT doc_id, unnest(s) AS g FROM sets),
pairs AS (SELECT a.doc_id AS x, b.doc_id AS y, COUNT(*) AS n FROM items a JOIN items b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (SELECT x, y FROM pairs JOIN sets p ON p.doc_id = x JOIN sets q ON q.doc_id = y WHERE 100 * n >= 85 * (len(p.s) + len(q.s) - n)),
ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach AS (SELECT doc_id, doc_id AS r FROM documents UNION SELECT reach.doc_id, ways.y FROM reach JOIN ways ON ways.x = reach.r),
least AS (SELECT doc_id, MIN(r) AS component_id FROM reach GROUP BY 1)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept FROM sets JOIN least USING (doc_id)"""

def _lloyd(rounds: int = 4) -> str:
    """Lloyd rounds, each a nearest entry of every part and the floored means of the members."""
    steps = """WITH vectors AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS (SELECT vec_id, p, v[p * (len(v) // 4) + 1 : (p + 1) * (len(v) // 4)] AS x FROM vectors CROSS JOIN (SELECT unnest(range(4)) AS p)),
seeds AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM vectors ORDER BY vec_id LIMIT 256),
book0 AS (SELECT p, e, x AS c FROM parts JOIN seeds USING (vec_id)),
"""
    for r in range(rounds + 1):
        steps += f"""near{r} AS (SELECT vec_id, p, MIN({{'d': list_dot_product(x, x) - 2 * list_dot_product(x, c) + list_dot_product(c, c), 'e': e}}) AS b
  FROM parts JOIN book{r} USING (p) GROUP BY vec_id, p),
"""
        if r < rounds:
            steps += f"""means{r} AS (SELECT p, e, list(m ORDER BY i) AS c FROM (SELECT p, b.e AS e, i, floor(SUM(y) / COUNT(*)) AS m
  FROM (SELECT p, b, unnest(x) AS y, unnest(range(len(x))) AS i FROM near{r} JOIN parts USING (vec_id, p)) GROUP BY p, b.e, i) GROUP BY p, e),
book{r + 1} AS (SELECT p, e, COALESCE(n.c, o.c) AS c FROM book{r} o LEFT JOIN means{r} n USING (p, e)),
"""
    return steps + f"""digest AS (SELECT sha256(string_agg(CAST(CAST(y AS BIGINT) AS VARCHAR), ',' ORDER BY p, e, i)) AS d
  FROM (SELECT p, e, unnest(c) AS y, unnest(range(len(c))) AS i FROM book{rounds})),
coded AS (SELECT vec_id, string_agg(lpad(lower(to_hex(b.e)), 2, '0'), '' ORDER BY p) AS code, CAST(SUM(b.d) AS BIGINT) AS error FROM near{rounds} GROUP BY vec_id)
SELECT vec_id, code, error, CAST(SUM(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, d AS codebooks_sha256
FROM coded JOIN vectors USING (vec_id) CROSS JOIN digest"""


SQL: dict[str, str] = {"op7_circulant_minhash": _NEAR_COPIES, "op11_vector_codes": _lloyd()}
