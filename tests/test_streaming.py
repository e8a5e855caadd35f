from __future__ import annotations

import datetime as dt

import pytest
from conftest import rows
from pyspark.sql import functions as F

from basketry.contracts import ENTITIES, ENVELOPE, ORDER_PREVIEW
from basketry.operators.cleaning import clean
from basketry.session import new_folder
from basketry.sources import files
from basketry.sources.lake import Lake, layer_counts, preview, register_views, schema_report, stacked_counts
from basketry.sources.messages import broker_options, number_lines, publish_stats, to_messages
from basketry.streaming.ingest import as_topic, folder_stream, land, land_all, parsed, preview_stream

AT = dt.datetime(2024, 6, 1, 8)
RAW = "id bigint, body string, at timestamp"


def drop_files(spark, folder, *batches):
    """One file per batch."""
    for batch in batches:
        spark.createDataFrame([(i, f'{{"order_id": "o{i}", "quantity": {i}}}', AT + dt.timedelta(seconds=i)) for i in batch], RAW).coalesce(1).write.mode("append").parquet(folder)


def topic_of(spark, folder, per_batch=None):
    df = folder_stream(spark, folder, RAW, "*.parquet", per_batch)
    return as_topic(df, F.col("id"), F.col("body"), F.lit("orders"), F.pmod("id", F.lit(2)), F.col("id"), F.col("at"))


def expected(ids):
    return [(str(i), f'{{"order_id": "o{i}", "quantity": {i}}}', "orders", i % 2, i, AT + dt.timedelta(seconds=i)) for i in ids]


def test_stream_in_batches_equals_one_batch_and_restart_adds_nothing(spark):
    source, lake = new_folder(spark, "source"), Lake(spark, root=new_folder(spark, "lake"))
    drop_files(spark, source, range(0, 10), range(10, 25), range(25, 30))
    checkpoint = f"{lake.root}/checkpoint"
    land(lake, topic_of(spark, source, per_batch=1), "bronze", checkpoint)
    want = sorted(expected(range(30)), key=str)
    assert sorted(rows(lake.read("bronze")), key=str) == want
    assert [(f.name, f.dataType) for f in lake.read("bronze").schema] == [(f.name, f.dataType) for f in ENVELOPE]
    land(lake, topic_of(spark, source), "bronze", checkpoint)
    assert lake.read("bronze").count() == 30
    drop_files(spark, source, range(30, 33))
    land(lake, topic_of(spark, source), "bronze", checkpoint)
    assert sorted(rows(lake.read("bronze")), key=str) == sorted(expected(range(33)), key=str)


def test_all_topics_land_together(spark):
    lake = Lake(spark, root=new_folder(spark, "lake"))
    topics = {}
    for size, entity in enumerate(ENTITIES, start=3):
        source = new_folder(spark, f"source-{entity}")
        drop_files(spark, source, range(size))
        topics[entity] = topic_of(spark, source)
    names = land_all(lake, topics, f"{lake.root}/checkpoints")
    assert names == [f"bronze_{e}" for e in ENTITIES]
    assert [lake.read(n).count() for n in names] == [3, 4, 5, 6, 7]


def test_a_failing_topic_stops_the_others(spark):
    lake = Lake(spark, root=new_folder(spark, "lake"))
    good, bad = new_folder(spark, "good"), new_folder(spark, "bad")
    drop_files(spark, good, range(3))
    drop_files(spark, bad, range(3))
    broken = topic_of(spark, bad).withColumn("value", F.raise_error(F.lit("broken")).cast("binary"))
    with pytest.raises(Exception):
        land_all(lake, {"bad": broken, "good": topic_of(spark, good)}, f"{lake.root}/checkpoints")
    assert not spark.streams.active


def test_preview_holds_a_bounded_number_of_rows(spark):
    source = new_folder(spark, "source")
    drop_files(spark, source, range(0, 40), range(40, 90))
    seen = preview_stream(topic_of(spark, source), "raw_preview", rows=50)
    assert seen.count() == 50 and spark.table("raw_preview").select("offset").distinct().count() == 50
    body = folder_stream(spark, source, RAW, "*.parquet").select(F.col("body").alias("value"))
    typed = preview_stream(parsed(body, ORDER_PREVIEW), "parsed_preview", rows=500)
    assert typed.count() == 90 and typed.columns == ORDER_PREVIEW.fieldNames()
    assert typed.where("order_id = 'o7'").first()["quantity"] == 7


def test_catalog_tables_and_views(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS layers")
    lake = Lake(spark, database="layers")
    lake.overwrite(spark.range(5).withColumn("old", F.lit(1)), "t")
    lake.overwrite(spark.range(3).withColumn("m", F.lit("2024-06")), "t", partition_by=["m"])
    assert lake.read("t").columns == ["id", "m"] and lake.read("t").count() == 3
    assert rows(lake.counts(["t"])) == [("t", 3)]
    source = new_folder(spark, "source")
    drop_files(spark, source, range(4))
    land(lake, topic_of(spark, source), "bronze_orders", new_folder(spark, "checkpoint"))
    assert lake.read("bronze_orders").count() == 4
    assert register_views({"a": spark.range(2)}, "gold_") == ["gold_a"]
    assert spark.sql("SELECT COUNT(*) FROM gold_a").first()[0] == 2


def test_layer_counts_and_reports(spark):
    bronze = spark.createDataFrame([("a", 1), ("a", 1), ("b", 2)], "k string, n int")
    assert rows(layer_counts({"orders": bronze}, {"orders": clean(bronze)})) == [("orders", 3, 2)]
    assert rows(stacked_counts({"x": bronze, "y": bronze.limit(0)})) == [("x", 3), ("y", 0)]
    assert rows(schema_report({"t": bronze})) == [("t", 0, "k", "string", 3, 3), ("t", 1, "n", "int", 3, 3)]
    assert rows(preview(bronze, 2, ["k", "n"])) == [("a", 1), ("a", 1)]
    assert preview(bronze, 1).count() == 1


# ----- messages and files ----------------------------------------------------------------


def test_message_keys(spark):
    body = ['{"order_id": "a"}', '{"other": 1}', '{"order_id": null}', "not json", '{"order_id": 5}', "[1]", None]
    df = spark.createDataFrame(list(enumerate(body)), "n bigint, value string")
    got = rows(to_messages(df, "orders", F.col("n")))
    assert got == [("1", '{"other": 1}', "orders"), ("5", '{"order_id": 5}', "orders"), ("None", '{"order_id": null}', "orders"), ("a", '{"order_id": "a"}', "orders")]
    assert rows(publish_stats(df.withColumn("topic", F.lit("orders")))) == [("orders", 4, 3)]


def test_lines_are_numbered_without_gaps(spark):
    folder = new_folder(spark, "lines")
    files.write_lines(spark.range(0, 1000, 1, 7).select(F.concat(F.lit("line "), "id").alias("value")), folder)
    numbered = number_lines(files.read_lines(spark, folder))
    assert sorted(r["line"] for r in numbered.collect()) == list(range(1000))
    kept = number_lines(files.read_lines(spark, folder).where("value LIKE '%7'"))
    assert sorted(r["line"] for r in kept.collect()) == list(range(100))


def test_csv_and_json_lines_round_trip(spark):
    df = spark.createDataFrame([(1, "a,b\"c", 1.5, AT), (2, None, None, None)], "n int, s string, d double, t timestamp")
    folder = new_folder(spark, "csv")
    files.write_csv(df, folder)
    assert rows(files.read_csv(spark, folder, df.schema)) == rows(df)
    folder = new_folder(spark, "jsonl")
    files.write_lines(files.encode(df), folder)
    assert rows(files.read_json_lines(spark, folder, df.schema)) == rows(df)


def test_json_writes_nulls_and_iso_times(spark):
    df = spark.createDataFrame([(1, None, AT)], "n int, s string, t timestamp")
    assert files.encode(df).first()[0] == '{"n":1,"s":null,"t":"2024-06-01T08:00:00"}'


def test_versioned_json_omits_the_field(spark):
    df = spark.createDataFrame([(1, "x"), (2, None), (3, "y")], "seq int, coupon_code string")
    got = [r[0] for r in df.select(files.versioned_json(df, "coupon_code", F.col("seq") >= 2)).collect()]
    assert got == ['{"seq":1}', '{"seq":2,"coupon_code":null}', '{"seq":3,"coupon_code":"y"}']


def test_broker_options():
    assert broker_options("host:1") == {"kafka.bootstrap.servers": "host:1"}
    secured = broker_options("host:1", "u", "p")
    assert secured["kafka.security.protocol"] == "SASL_SSL" and 'username="u"' in secured["kafka.sasl.jaas.config"]
