"""JSON payload decoding: by contract, by inferred schema, and drift reports."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.contracts import CONTRACTS
from basketry.functions.columns import row_digest, to_event_date
from basketry.operators.cleaning import drop_empty_rows, trim_strings


def decode_typed(df: DataFrame, schema: T.StructType, keep: dict[str, str] | None = None) -> DataFrame:
    """Columns of ``schema`` from the JSON text in ``value``.

    A field that does not fit its type is null, an unreadable document is all
    null. ``keep`` carries envelope columns along under new names.
    """
    kept = [F.col(old).alias(new) for old, new in (keep or {}).items()]
    return df.select(F.from_json("value", schema).alias("data"), *kept).select("data.*", *[k for k in (keep or {}).values()])


def decode_entity(df: DataFrame, entity: str, keep: Sequence[str] = ()) -> DataFrame:
    """Business columns of an entity plus the message time and the columns in ``keep``."""
    return decode_typed(df, CONTRACTS[entity], keep={"timestamp": "kafka_timestamp", **{c: c for c in keep}})


def conform_entity(df: DataFrame, entity: str, keep: Sequence[str] = ()) -> DataFrame:
    """Decoded entity with the parsing that every metric would otherwise repeat.

    Orders get ``event_date`` next to the event time text.
    """
    typed = decode_entity(df, entity, keep)
    return typed.withColumn("event_date", to_event_date(typed)) if "event_time" in typed.columns else typed


def conform_messages(messages: DataFrame, entity: str) -> DataFrame:
    """``conform_entity`` of the cleaned messages, without a shuffle of their texts.

    A message's identity is a digest of 128 bits of all its columns as they came. Texts are decoded where they are, and only
    digests and the decoded columns that are asked for are shuffled. Fields are no keys of that aggregate, so
    Spark moves no condition on them below it, where the text would be made and parsed once more for it.
    """
    digest = [h.alias(f"__{name}") for h, name in zip(row_digest(messages.columns), ("h1", "h2"))]
    marked = trim_strings(drop_empty_rows(messages).select("*", *digest))
    return conform_entity(marked, entity, ("__h1", "__h2")).dropDuplicates(["__h1", "__h2"]).drop("__h1", "__h2")


def payload_type(df: DataFrame, column: str = "value") -> DataFrame:
    """One row: type that fits every payload, merged over all rows."""
    return df.agg(F.expr(f"schema_of_variant_agg(try_parse_json({column}))").alias("payload_type"))


def _plain_type(kind: T.DataType) -> T.DataType:
    """The type with STRING wherever values are null everywhere or of several kinds."""
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _plain_type(f.dataType)) for f in kind])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_plain_type(kind.elementType))
    return T.StringType() if isinstance(kind, (T.NullType, T.VariantType)) else kind


_FIELD = re.compile(r"(OBJECT<|, )(`(?:[^`]|``)*`|[^`:<>, ]+): ")


def spark_type(variant_type: str) -> T.DataType:
    """Type of a merged variant; decimals keep their digits.

    Names are quoted first, so that a field may be called like a type.
    """
    text = _FIELD.sub(lambda m: f"{m[1]}{m[2] if m[2].startswith('`') else f'`{m[2]}`'}: ", variant_type)
    # outside of quotes only types are left
    parts = text.split("`")
    parts[::2] = [p.replace("OBJECT<", "STRUCT<") for p in parts[::2]]
    return _plain_type(T.DataType.fromDDL("`".join(parts)))


def infer_schema(df: DataFrame, column: str = "value") -> T.StructType:
    """Schema of the payloads as a type object; only the merged type is collected.

    An empty or unreadable table gives a schema without fields.
    """
    found = payload_type(df, column).first()[0]
    if not found or not found.startswith("OBJECT<") or found == "OBJECT<>":
        return T.StructType([])
    return spark_type(found)


def decode_inferred(df: DataFrame) -> DataFrame:
    """Decode by the merged schema of all rows; adds the message time."""
    schema = infer_schema(df)
    if not schema.fields:
        return df.select(F.col("timestamp").alias("kafka_timestamp"))
    return decode_typed(df, schema, keep={"timestamp": "kafka_timestamp"})


def field_presence(df: DataFrame, column: str = "value") -> DataFrame:
    """(field, messages) over all payloads: how often each top-level key occurs."""
    return (
        df.select(F.explode(F.json_object_keys(column)).alias("field"))
        .groupBy("field").agg(F.count(F.lit(1)).alias("messages"))
    )


def unknown_fields(df: DataFrame, schema: T.StructType, column: str = "value") -> DataFrame:
    """Top-level keys the contract does not name."""
    return field_presence(df, column).where(~F.col("field").isin(*schema.fieldNames()))


def unreadable(df: DataFrame, column: str = "value") -> DataFrame:
    """Rows whose payload is missing or not JSON."""
    return df.where(F.expr(f"try_parse_json({column})").isNull())
