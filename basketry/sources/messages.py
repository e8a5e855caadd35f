"""Keyed messages: building them from JSON lines, publishing, broker access."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from basketry.contracts import PRIMARY_KEY
from basketry.session import stage


def broker_options(servers: str, user: str | None = None, password: str | None = None) -> dict[str, str]:
    """Connection options; with a user the connection is SASL over TLS."""
    options = {"kafka.bootstrap.servers": servers}
    if user is not None:
        login = (
            "org.apache.kafka.common.security.plain.PlainLoginModule required "
            f'username="{user}" password="{password}";'
        )
        options |= {
            "kafka.security.protocol": "SASL_SSL", "kafka.sasl.mechanism": "PLAIN", "kafka.sasl.jaas.config": login,
        }
    return options


#: Messages of a micro-batch: a run over a long topic commits as it goes.
PER_BATCH = 10_000_000


def topic_stream(spark: SparkSession, topics: str, options: dict[str, str], per_batch: int | None = PER_BATCH) -> DataFrame:
    """Unbounded scan of one topic or a comma separated list, from the first offset; None takes all at once."""
    reader = (
        spark.readStream.format("kafka").options(**options)
        .option("subscribe", topics).option("startingOffsets", "earliest")
    )
    if per_batch:
        reader = reader.option("maxOffsetsPerTrigger", per_batch)
    return reader.load()


def envelope(raw: DataFrame) -> DataFrame:
    """Text key and value with the message's position; binary is read as UTF-8."""
    return raw.select(
        F.col("key").cast("string").alias("message_key"), F.col("value").cast("string").alias("value"),
        "topic", "partition", "offset", "timestamp",
    )


def number_lines(lines: DataFrame) -> DataFrame:
    """Add ``line``: dense 0-based position in scan order, without gathering the rows.

    Rows are numbered inside their scan partition and written, so that counting and numbering see the same
    partitions; the window runs over one row per partition.
    """
    inside = F.monotonically_increasing_id()
    numbered = stage(lines.withColumns({"__part": F.spark_partition_id(), "__at": inside.bitwiseAND((1 << 33) - 1)}), "numbered-lines")
    sizes = numbered.groupBy("__part").agg(F.count(F.lit(1)).alias("rows"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("__part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("__start"))
    return (
        numbered.join(starts, "__part")
        .withColumn("line", F.col("__start") + F.col("__at")).drop("__part", "__at", "__start")
    )


def is_document(value: Column) -> Column:
    return F.json_object_keys(value).isNotNull()


def message_key(value: Column, field: str, sequence: Column) -> Column:
    """Key text of a document.

    A missing field takes the running number, a field that is present but
    null becomes the text ``None``.
    """
    present = F.array_contains(F.json_object_keys(value), field)
    return F.when(~present, sequence.cast("string")).otherwise(
        F.coalesce(F.get_json_object(value, f"$.{field}"), F.lit("None"))
    )


def to_messages(lines: DataFrame, topic: str, sequence: Column, key_field: str | None = None) -> DataFrame:
    """(key, value, topic) of every readable line; unreadable ones are left out and counted by ``publish_stats``."""
    field = key_field or PRIMARY_KEY[topic]
    value = F.col("value")
    return lines.where(is_document(value)).select(
        message_key(value, field, sequence).alias("key"), value, F.lit(topic).alias("topic"),
    )


def publish(messages: DataFrame, options: dict[str, str]) -> None:
    """Send messages to a broker; batching, retries and acknowledgements are the connector's."""
    messages.write.format("kafka").options(**options).save()


def publish_counted(lines: DataFrame, topics: Sequence[str], send: Callable[[DataFrame], None]) -> DataFrame:
    """Send the readable lines and count them as they go by: (topic, published, failed), one row a topic.

    ``lines`` has ``topic`` and what ``send`` needs. The counters are metrics of the sending job itself, so the lines are read
    once. Lines of a topic that is not listed are counted under a null topic, if there are any.
    """
    good = is_document(F.col("value"))
    known = F.col("topic").isin(*topics)
    of = [F.col("topic") == t for t in topics] + [~F.coalesce(known, F.lit(False))]
    metrics = [F.count_if(mine & F.coalesce(ok, F.lit(False))).alias(f"{name}_{i}") for i, mine in enumerate(of) for name, ok in (("published", good), ("failed", ~good))]
    seen = Observation()
    send(lines.observe(seen, *metrics).where(good))
    found = seen.get
    rows = [(t, found[f"published_{i}"], found[f"failed_{i}"]) for i, t in enumerate([*topics, None])]
    rows = [r for r in rows if r[0] is not None or r[1] + r[2]]
    return lines.sparkSession.createDataFrame(rows, "topic string, published long, failed long")


def publish_stats(lines: DataFrame) -> DataFrame:
    """(topic, published, failed) of lines that carry their ``topic``."""
    return lines.groupBy("topic").agg(
        F.count_if(is_document(F.col("value"))).alias("published"),
        F.count_if(F.json_object_keys("value").isNull()).alias("failed"),
    )
