"""Named tables of the bronze, silver and gold layers.

With ``database`` tables live in the catalog (``saveAsTable``); with ``root``
they are folders. ``provider`` is the storage format: parquet by default,
``delta`` where the session has it.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery


@dataclass(frozen=True)
class Lake:
    spark: SparkSession
    root: str | None = None
    database: str | None = None
    provider: str = "parquet"

    def _path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    def _table(self, name: str) -> str:
        return f"{self.database}.{name}" if self.database else name

    def read(self, name: str, schema: T.StructType | None = None) -> DataFrame:
        """The table; ``schema`` is needed where a partitioned table may be empty, which leaves no file to tell it."""
        if self.root:
            reader = self.spark.read.format(self.provider)
            return (reader.schema(schema) if schema is not None else reader).load(self._path(name))
        return self.spark.table(self._table(name))

    def overwrite(self, df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> DataFrame:
        """Replace the table and its schema, then read it back."""
        writer = df.write.format(self.provider).mode("overwrite").option("overwriteSchema", "true")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        if self.root:
            writer.save(self._path(name))
        else:
            writer.saveAsTable(self._table(name))
        return self.read(name, df.schema if partition_by and self.provider != "delta" else None)

    def replace_partitions(self, df: DataFrame, name: str, by: Sequence[str]) -> DataFrame:
        """Replace the partitions that ``df`` has rows of, and no others; a repeated write leaves the same table."""
        writer = df.write.format(self.provider).mode("overwrite").option("partitionOverwriteMode", "dynamic")
        if self.root:
            writer.partitionBy(*by).save(self._path(name))
        elif self.spark.catalog.tableExists(self._table(name)):
            rest = [c for c in df.columns if c not in by]
            df.select(*rest, *by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").insertInto(self._table(name))
        else:
            writer.partitionBy(*by).saveAsTable(self._table(name))
        return self.read(name, df.schema if self.provider != "delta" else None)

    def append_stream(self, df: DataFrame, name: str, checkpoint: str) -> StreamingQuery:
        """Start a run that appends everything available now and stops."""
        writer = (
            df.writeStream.format(self.provider).outputMode("append")
            .option("checkpointLocation", checkpoint).trigger(availableNow=True)
        )
        return writer.start(self._path(name)) if self.root else writer.toTable(self._table(name))

    def counts(self, names: Iterable[str]) -> DataFrame:
        """(table, rows) in one job."""
        return stacked_counts({n: self.read(n) for n in names})


def stacked_counts(frames: dict[str, DataFrame], label: str = "table") -> DataFrame:
    """(label, rows): one row per frame, computed as a union of aggregates."""
    parts = [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias(label), "rows") for name, df in frames.items()]
    total = parts[0]
    for part in parts[1:]:
        total = total.unionByName(part)
    return total


def layer_counts(before: dict[str, DataFrame], after: dict[str, DataFrame]) -> DataFrame:
    """(table, bronze_count, silver_count) per entity."""
    bronze = stacked_counts(before).withColumnRenamed("rows", "bronze_count")
    silver = stacked_counts(after).withColumnRenamed("rows", "silver_count")
    return bronze.join(silver, "table", "full")


def register_views(frames: dict[str, DataFrame], prefix: str) -> list[str]:
    """Session views ``prefix + name``; returns the view names."""
    for name, df in frames.items():
        df.createOrReplaceTempView(f"{prefix}{name}")
    return [f"{prefix}{name}" for name in frames]


def schema_report(frames: dict[str, DataFrame]) -> DataFrame:
    """(table, position, column, type, rows, filled): one scan per table."""
    parts = []
    for table, df in frames.items():
        counts = [F.count(F.col(f"`{c}`")).alias(f"c{i}") for i, c in enumerate(df.columns)]
        entries = F.array(*[
            F.struct(
                F.lit(i).alias("position"), F.lit(f.name).alias("column"),
                F.lit(f.dataType.simpleString()).alias("type"), F.col(f"c{i}").alias("filled"),
            )
            for i, f in enumerate(df.schema.fields)
        ])
        parts.append(
            df.agg(F.count(F.lit(1)).alias("rows"), *counts)
            .select(F.lit(table).alias("table"), "rows", F.inline(entries))
            .select("table", "position", "column", "type", "rows", "filled")
        )
    total = parts[0]
    for part in parts[1:]:
        total = total.unionByName(part)
    return total


def preview(df: DataFrame, rows: int, order_by: Sequence[str] = ()) -> DataFrame:
    """First rows; in a fixed order when one is named."""
    return df.orderBy(*order_by).limit(rows) if order_by else df.limit(rows)
