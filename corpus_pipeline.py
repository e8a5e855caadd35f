"""The corpus pipeline: five stages from raw documents to token ids.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes it as
Parquet in the shared folder and hands what it reads back to the next stage. All but
the last stage return the columns of ``docs``, so other columns pass through.

  language      documents of no known language, or whose two best languages are too close, go
  near_dedup    one document of each near-duplicate group stays (five words, similarity 0.8)
  decontaminate documents that overlap a benchmark item go
  secrets       secrets are replaced by a mark; n_chars follows the text
  encode        ids of each text, and whether they decode to it
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.llm import circulant, language_id, pieces, secrets, spaced_seeds
from basketry.llm.catalog import piece_model
from basketry.llm.common import documents, small_batches, with_ids
from basketry.session import stage

#: SQL has no language model, signatures, structure checks or token merges.
ORACLE_SQL = None


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with one clear language."""
    small_batches(spark)
    model = language_id.learn(docs)
    found = docs.select(F.struct(*docs.columns).alias("row"), language_id.predict(F.col("text"), model).alias("language"))
    return found.where((F.col("language.lang_pred") != language_id.UNKNOWN) & ~F.col("language.ambiguous")).select("row.*")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one of the least id. Rows without an id stay."""
    found = circulant.near_copies(docs)
    copies = stage(found.where(~F.col("kept") & F.col("doc_id").isNotNull()).select("doc_id").distinct(), "pipeline-copies")
    return with_ids(docs, copies, "left_anti").select(docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap no benchmark item. Rows without an id stay."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = stage(spaced_seeds.overlaps(docs, items).where("doc_id is not null").select("doc_id").distinct(), "pipeline-leaks")
    return with_ids(docs, found, "left_anti").select(docs.columns)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets replaced; n_chars counts the new text."""
    masked = docs.withColumn("text", secrets.mask(F.col("text")))
    if "n_chars" in docs.columns:
        masked = masked.withColumn("n_chars", F.coalesce(F.length("text").cast(docs.schema["n_chars"].dataType), F.col("n_chars")))
    return masked


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All columns but the text, which becomes ids; n_tokens; and whether the ids decode to the text."""
    rest = [c for c in docs.columns if c not in ("text", "ids", "n_tokens", "decodes")]
    coded = docs.select(F.struct(F.lit(0).alias("_"), *rest).alias("row"), pieces.round_trip(F.col("text"), piece_model()).alias("code"))
    return coded.select(*[F.col("row")[c].alias(c) for c in rest], "code.ids", F.size("code.ids").cast("long").alias("n_tokens"), "code.decodes")


STAGES = [
    ("language", language), ("near_dedup", near_dedup), ("decontaminate", decontaminate), ("secrets", mask_secrets), ("encode", encode)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table, each written and read again."""
    docs = documents(spark, sf_dir)
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
