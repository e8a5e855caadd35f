"""Streams with state, and the sinks around them: fan-out, keyed de-duplication, windows that close, late rows apart."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.sources.lake import Lake

BATCH = "batch"


def land_batch(lake: Lake, batch: DataFrame, number: int, name: str, by: str) -> None:
    """Write one micro-batch, split by a column, in one job.

    Every value of ``by`` is a folder with a partition a batch. A batch that is repeated after a crash has the same number and the same
    rows, and replaces its own partitions.
    """
    lake.replace_partitions(batch.withColumn(BATCH, F.lit(number)), name, [by, BATCH])


def fan_out(lake: Lake, stream: DataFrame, name: str, by: str, checkpoint: str) -> None:
    """Take everything available of one subscription and split it by a column; returns when it is landed."""
    query = stream.writeStream.foreachBatch(lambda batch, number: land_batch(lake, batch, number, name, by))
    query.option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def share_of(lake: Lake, name: str, by: str, value) -> DataFrame:
    """The table of one value of a fan-out; only its folder is read."""
    return lake.read(name).where(F.col(by) == F.lit(value)).drop(BATCH)


def first_arrivals(stream: DataFrame, keys: Sequence[str], event_time: str, delay: str) -> DataFrame:
    """The first row of each key; copies may come up to ``delay`` later in event time, after which the key is forgotten."""
    return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(list(keys))


def window_sums(stream: DataFrame, event_time: str, delay: str, width: str, **sums: Column) -> DataFrame:
    """(start, end, rows, sums): totals of event-time windows.

    In append mode a window is given out once, when the watermark passes its end, and its state is dropped.
    """
    window = F.window(event_time, width)
    totals = stream.withWatermark(event_time, delay).groupBy(window.alias("w")).agg(
        F.count(F.lit(1)).alias("rows"), *[F.sum(c).alias(n) for n, c in sums.items()])
    return totals.select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), "rows", *sums)


def split_late(stream: DataFrame, late: Column) -> tuple[DataFrame, DataFrame]:
    """Rows on time and late rows, ahead of any operator with state.

    Such an operator drops what is behind its watermark without a word. With the same allowance on both, no row on time is
    behind it, and every late row is in the second stream.
    """
    late = F.coalesce(late, F.lit(False))
    return stream.where(~late), stream.where(late)
