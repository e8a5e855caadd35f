"""CSV and JSON-lines files of the entity tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ISO_SECONDS = "yyyy-MM-dd'T'HH:mm:ss"


def write_csv(df: DataFrame, folder: str) -> None:
    """CSV with a header line; every row has every column, null is empty."""
    df.write.mode("overwrite").option("header", True).option("timestampFormat", ISO_SECONDS).csv(folder)


def read_csv(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    """CSV by contract; a value that does not fit is null."""
    return (
        spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE")
        .option("timestampFormat", ISO_SECONDS).csv(folder)
    )


def json_text(*columns: Column) -> Column:
    """One JSON document; nulls are written, times are ISO text."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false", "timestampFormat": ISO_SECONDS, "timestampNTZFormat": ISO_SECONDS})


def encode(df: DataFrame) -> DataFrame:
    """(value): one JSON document per row."""
    return df.select(json_text(*[F.col(c) for c in df.columns]).alias("value"))


def versioned_json(df: DataFrame, new_column: str, has_it: Column) -> Column:
    """JSON of the row; ``new_column`` is left out entirely where ``has_it`` is not true.

    That is how a payload looks before a field was introduced, as opposed to
    a field that is present and null.
    """
    older = [F.col(c) for c in df.columns if c != new_column]
    return F.when(has_it, json_text(*[F.col(c) for c in df.columns])).otherwise(json_text(*older))


def write_lines(values: DataFrame, folder: str) -> None:
    """Text files, one document per line."""
    values.select("value").write.mode("overwrite").text(folder)


def read_lines(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.text(folder)


def read_json_lines(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    """Decoded documents by contract, without an inference pass."""
    return spark.read.schema(schema).json(folder)
