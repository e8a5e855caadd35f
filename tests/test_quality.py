"""Quality reports, quarantine and digest cleaning: results, and how often inputs are read."""

from __future__ import annotations

import os
import re

import pytest
from conftest import rows
from pyspark.sql import functions as F

from basketry import session
from basketry.catalog import REGISTRY, tables
from basketry.operators import cleaning, quality
from basketry.operators.decode import conform_entity, conform_messages
from basketry.session import new_folder
from basketry.sources.lake import Lake

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
needs_tables = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def scanned(df):
    return sorted(re.findall(r"/(\w+)\.parquet\]", plan(df)))


@needs_tables
def test_reports_read_every_table_once(spark):
    run = lambda name: REGISTRY[name].run(spark, SF)
    assert scanned(run("dq_duplicates")) == ["customer", "events", "lineitem", "orders", "part"]
    assert scanned(run("dq_nulls")) == ["customer", "events", "lineitem", "orders", "part"]
    assert scanned(run("dq_referential")) == ["customer", "lineitem", "orders", "part", "supplier"]
    for name, exchanges in (("dq_duplicates", 2), ("dq_referential", 2)):  # of rows, and of one row a check
        assert len(re.findall(r"Exchange hashpartitioning\((?:check|link)#", plan(run(name)))) == exchanges, name


@needs_tables
def test_quarantine_reads_every_input_once(spark):
    df = cleaning.judged(
        tables.spoiled_orders(spark, SF), {"price_negative": F.col("o_totalprice") < 0},
        [("o_custkey", spark.read.parquet(f"{SF}/customer.parquet"), "c_custkey")])
    assert scanned(df) == ["customer", "orders"]


def test_duplicates_tell_nulls_from_values_and_columns_apart(spark):
    df = spark.createDataFrame([(1, None, "a"), (2, "a", None), (3, None, "a"), (4, None, None), (5, None, None), (6, "", "")], "id int, a string, b string")
    got = quality.duplicate_report({"a, b": (df, ["a", "b"]), "id": (df, ["id"]), "a": (df, ["a"]), "none": (df.limit(0), ["a"])})
    assert rows(got) == [("a", 6, 3), ("a, b", 6, 2), ("id", 6, 0), ("none", 0, 0)]


def test_references_of_chained_tables(spark):
    """A frame that is child and parent, a parent's repeated and null keys, ghost and null foreign keys, an empty child."""
    top = spark.createDataFrame([(1,), (1,), (2,), (None,)], "t long")
    mid = spark.createDataFrame([(10, 1), (11, 9), (12, None), (13, 2)], "m long, t long")
    low = spark.createDataFrame([(10,), (10,), (99,), (None,)], "m long")
    got = quality.reference_report([("mid", mid, "t", "top", top, "t"), ("low", low, "m", "mid", mid, "m"), ("none", low.limit(0), "m", "mid", mid, "m")])
    assert rows(got) == [("low", "m", "mid", 4, 2), ("mid", "t", "top", 4, 2), ("none", "m", "mid", 0, 0)]


def test_route_loses_no_row(spark):
    df = spark.createDataFrame([(1, 5.0, 1), (2, -1.0, 1), (3, None, 7), (4, -2.0, None), (4, -2.0, None)], "id int, price double, customer long")
    parent = spark.createDataFrame([(1,), (2,), (None,)], "c long")
    routed = cleaning.route(df, {"negative": F.col("price") < 0}, [("customer", parent, "c")], Lake(spark, root=new_folder(spark, "routed")), "orders")
    assert rows(routed.accepted) == [(1, 5.0, 1)]
    assert rows(routed.rejected.select("id", F.concat_ws("+", "reasons"))) == [
        (2, "negative"), (3, "customer_orphan"), (4, "negative+customer_orphan"), (4, "negative+customer_orphan")]
    assert rows(routed.accepted.unionByName(routed.rejected.drop("reasons"))) == rows(df)
    none = cleaning.route(df.limit(0), {}, [], Lake(spark, root=new_folder(spark, "routed")), "orders")
    assert none.accepted.count() == none.rejected.count() == 0


@pytest.mark.parametrize("at_once", [500_000, 0])
def test_drop_copies_equals_distinct(spark, monkeypatch, at_once):
    monkeypatch.setattr(cleaning, "COPIES_AT_ONCE", at_once)
    data = [("k", " v", 0, 1), ("k", " v", 0, 1), ("k", "v", 0, 1), ("k", None, 0, 2), (None, "k", 0, 2), (None, None, None, None), (None, None, None, None)] + [("hot", "x" * 50, 1, 5)] * 300
    df = spark.createDataFrame(data, "message_key string, value string, partition int, offset int")
    stored = Lake(spark, root=new_folder(spark, "bronze")).overwrite(df.repartition(5), "bronze")
    kept = cleaning.drop_copies(stored)
    assert rows(kept) == rows(df.distinct()) and kept.columns == df.columns
    assert rows(cleaning.clean_stored(stored)) == rows(cleaning.clean(df))
    if at_once:  # the texts stay where they are
        assert "Exchange hashpartitioning" not in plan(kept) and "SortMergeJoin" not in plan(kept)


def test_many_copies_shuffle_no_texts(spark, monkeypatch):
    monkeypatch.setattr(cleaning, "COPIES_AT_ONCE", 100)
    df = spark.range(300).select(F.col("id").cast("string").alias("message_key"), F.repeat(F.lit("text"), 20).alias("value"))
    stored = Lake(spark, root=new_folder(spark, "bronze")).overwrite(df.unionByName(df).repartition(3, "message_key"), "bronze")
    kept = cleaning.drop_copies(stored)
    assert rows(kept) == rows(df)
    assert "SortMergeJoin" not in plan(kept) and "Exchange hashpartitioning" not in plan(kept)


def test_messages_are_decoded_before_copies_meet(spark):
    """The same rows as decoding cleaned messages; texts are not shuffled, and no condition has them parsed twice."""
    at = "timestamp'2024-05-01 10:00:00'"
    made = spark.range(40).selectExpr("cast(id as string) message_key", "to_json(struct(concat('p', id) payment_id, concat('o', id % 7) order_id, id * 1.5D amount)) value", "id offset", f"{at} timestamp")
    odd = spark.createDataFrame(
        [("a", " {\"order_id\": \"o1\"} ", 100), ("a ", "{\"order_id\": \"o1\"}", 100), ("a", "{broken", 101), ("a", None, 102), (None, "{}", 103), (None, None, None),
         ("a", "{\"order_id\": null, \"amount\": \"much\"}", 104), (None, "a", 105), ("a", None, 105)] + [("b", "{\"payment_id\": \"x\", \"amount\": -0.0}", 106)] * 3,
        "message_key string, value string, offset long").withColumn("timestamp", F.expr(f"if(offset is null, null, {at})"))
    messages = made.unionByName(made).unionByName(odd).unionByName(odd)
    expected = conform_entity(cleaning.clean(messages), "payments")
    got = conform_messages(messages, "payments")
    assert got.columns == expected.columns and rows(got) == rows(expected) and got.count() == 49
    used = plan(conform_messages(made.unionByName(made), "payments").where("order_id is not null").select("order_id"))
    dealt = [line for line in used.splitlines() if "Exchange hashpartitioning" in line]
    assert len(dealt) == 1 and "value" not in dealt[0]
    assert not re.search(r"Filter [^\n]*from_json", used)


@needs_tables
def test_plain_joins_store_no_entities(spark):
    before = len(session._FOLDERS)
    for name in ("entity_daily_revenue_fanout", "entity_top_customers"):
        REGISTRY[name].run(spark, SF)
    assert len(session._FOLDERS) == before
