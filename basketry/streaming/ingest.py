"""Bronze ingest: bounded incremental runs over topic streams."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.operators.decode import decode_typed
from basketry.session import new_folder
from basketry.sources.lake import Lake
from basketry.sources.messages import envelope


#: Files of a micro-batch.
PER_BATCH = 1_000


def folder_stream(spark: SparkSession, folder: str, schema: T.StructType | str, files: str = "*", per_batch: int | None = PER_BATCH) -> DataFrame:
    """Parquet files of a folder as a stream, oldest first, ``per_batch`` files at a time: stands in for a topic."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", files)
    if per_batch:
        reader = reader.option("maxFilesPerTrigger", per_batch)
    return reader.parquet(folder)


def as_topic(df: DataFrame, key: Column, value: Column, topic: Column, partition: Column, offset: Column, timestamp: Column) -> DataFrame:
    """Rows in the shape a broker source has: binary key and value plus position."""
    return df.select(
        key.cast("string").cast("binary").alias("key"), value.cast("binary").alias("value"), topic.alias("topic"),
        partition.cast("int").alias("partition"), offset.cast("bigint").alias("offset"),
        timestamp.cast("timestamp").alias("timestamp"),
    )


def land(lake: Lake, raw: DataFrame, name: str, checkpoint: str) -> None:
    """Append everything available to a bronze table and return.

    The checkpoint records what was read, so a further run adds only what is
    new, also after a crash in between.
    """
    lake.append_stream(envelope(raw), name, checkpoint).awaitTermination()


def land_all(lake: Lake, topics: Mapping[str, DataFrame], checkpoints: str, prefix: str = "bronze_") -> list[str]:
    """One query per topic, all running at the same time; returns when all are done."""
    running = {
        f"{prefix}{topic}": lake.append_stream(envelope(raw), f"{prefix}{topic}", f"{checkpoints}/{topic}")
        for topic, raw in topics.items()
    }
    try:
        for query in running.values():
            query.awaitTermination()
    finally:
        for query in running.values():
            if query.isActive:
                query.stop()
    return list(running)


def preview_stream(stream: DataFrame, name: str, rows: int = 50) -> DataFrame:
    """In-memory table ``name`` with the first rows to arrive.

    The limit is part of the streaming query, so the driver never holds more
    than ``rows`` rows however long the topic is.
    """
    spark = stream.sparkSession
    (
        stream.limit(rows).writeStream.outputMode("append").format("memory").queryName(name)
        .option("checkpointLocation", new_folder(spark, f"preview-{name}"))
        .trigger(availableNow=True).start().awaitTermination()
    )
    return spark.table(name)


def parsed(stream: DataFrame, schema: T.StructType) -> DataFrame:
    """Typed columns of an envelope stream; stateless."""
    return decode_typed(stream, schema)


def late_flag(event: Column, ingested: Column, allowed: str = "1 day") -> Column:
    """True when a message landed at least ``allowed`` after its event."""
    return F.coalesce(ingested >= event + F.expr(f"INTERVAL {allowed}"), F.lit(False))
