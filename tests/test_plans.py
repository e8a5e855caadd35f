"""What the plans must look like at any scale."""

from __future__ import annotations

import os
import re

import pytest
from conftest import rows
from pyspark.sql import functions as F

from basketry.catalog import REGISTRY
from basketry.operators import joins
from basketry.operators.joins import hot_keys
from basketry.plans.metrics import METRICS, metric
from basketry.plans.rfm import rfm_base
from basketry.plans.roles import StarRetail, stored

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def scans(df):
    """Table -> columns read, one entry per scan."""
    found = re.findall(r"/(\w+)\.parquet\].*?ReadSchema: struct<(.*?)>", plan(df))
    return sorted((table, sorted(c.split(":")[0] for c in columns.split(","))) for table, columns in found)


@pytest.fixture(scope="module")
def retail(spark):
    return StarRetail(spark, SF)


def test_metrics_read_only_what_they_use(retail):
    assert scans(metric("daily_revenue", retail)) == [
        ("lineitem", ["l_discount", "l_extendedprice", "l_orderkey"]), ("orders", ["o_orderdate", "o_orderkey"]),
    ]
    assert scans(metric("top_products", retail)) == [("lineitem", ["l_discount", "l_extendedprice", "l_partkey", "l_quantity"])]
    assert scans(metric("average_order_value", retail)) == [("lineitem", ["l_discount", "l_extendedprice"])]
    assert scans(metric("customer_lifetime_value", retail)) == [
        ("lineitem", ["l_discount", "l_extendedprice", "l_orderkey"]), ("orders", ["o_custkey", "o_orderkey"]),
    ]
    assert scans(metric("payment_summary", retail)) == [("orders", ["o_orderstatus"])]


@pytest.mark.parametrize("name", [m for m in METRICS if m not in ("average_order_value", "payment_success_rate")])
def test_no_metric_gathers_rows_in_one_task(retail, name):
    text = plan(metric(name, retail))
    assert "SinglePartition" not in text and "CartesianProduct" not in text and "NestedLoopJoin" not in text


@pytest.mark.parametrize("name", list(METRICS))
def test_no_metric_runs_python(retail, name):
    text = plan(metric(name, retail))
    assert "Python" not in text and "InPandas" not in text


def test_order_attributes_are_grouped_after_the_order_rollup(retail):
    """One row per order reaches the header join, however many lines an order has."""
    for name in ("daily_revenue", "customer_lifetime_value", "top_customers", "revenue_by_city"):
        text = plan(metric(name, retail))
        assert "count(distinct" not in text
        join, rollup = text.index("Join [order_id"), text.index("partial_sum(exact_amount")
        assert join < rollup or text.count("partial_sum(exact_amount") > 1


def test_partial_aggregation_everywhere(retail):
    for name in METRICS:
        assert "partial_" in plan(metric(name, retail))


def test_lookups_by_attribute_see_one_row_per_key(retail):
    text = plan(metric("revenue_by_state", retail))
    assert text.index("Join [customer_id") < text.index("keys=[customer_id")


def test_rfm_base_is_one_aggregate_per_customer(retail):
    assert "Window" not in plan(rfm_base(retail))


def test_filters_reach_the_scan(retail):
    failed = plan(metric("late_deliveries", retail))
    assert "Filter" in failed
    day = retail.order_dates.where(F.col("order_date") >= F.lit("2001-01-01").cast("date"))
    assert "PushedFilters: [IsNotNull(o_orderdate)" in plan(day)


def test_top_ten_needs_no_full_sort(spark):
    text = plan(REGISTRY["top10_products"].run(spark, SF))
    assert "TakeOrderedAndProject" in text and "rangepartitioning" not in text


def test_large_lookups_are_never_broadcast(spark, monkeypatch):
    monkeypatch.setattr(joins, "HOT_KEY_ROWS", 5)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        retail = StarRetail(spark, SF)
        for name in ("revenue_by_category", "sales_by_category", "top_customers"):
            df = metric(name, retail)
            hinted = re.findall(r"BroadcastHashJoin \[(\w+)#", plan(df))
            assert all(key in ("product_id", "order_id", "customer_id") for key in hinted)
            assert plan(df).count("BroadcastExchange") <= plan(df).count("hot-keys-")  # salts only
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_hot_keys_come_from_a_sample(spark):
    df = spark.range(400_000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"))
    [(key, rows_seen)] = hot_keys(df, "k", 50_000).collect()
    assert key == 0 and abs(rows_seen - 133_334) < 15_000
    sampled = df.select("k").sample(fraction=0.02, seed=1)
    assert sampled.count() < 10_000


def test_a_third_of_all_rows_on_one_key_spreads_over_the_partitions(spark):
    """Rows per join task, counted on the real plan: no task holds the hot key alone."""
    fact = spark.range(60_000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"), F.lit("x").alias("v"))
    side = spark.range(-1, 60_000).select(F.col("id").alias("k"), F.lit("y").alias("name"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        joined = joins.left_lookup(fact, side, "k", spread=True, hot_rows=1000)
        sizes = [r[0] for r in joined.groupBy(F.spark_partition_id()).count().select("count").collect()]
        plain = fact.join(side, "k", "left")
        plain_sizes = [r[0] for r in plain.groupBy(F.spark_partition_id()).count().select("count").collect()]
        assert sum(sizes) == sum(plain_sizes) == 60_000
        assert max(plain_sizes) > 20_000 and max(sizes) < 10_000
        assert rows(joined.groupBy("name").count()) == rows(plain.groupBy("name").count())
    finally:
        for key in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled"):
            spark.conf.unset(key)
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_gold_metrics_read_small_roll_ups(retail):
    """Of the stored roles no sales metric reads lines or orders again, and all figures stay."""
    kept = stored(retail)
    for name, record in METRICS.items():
        found = metric(name, kept)
        assert rows(found) == rows(metric(name, retail)), name
        if record.source == "sales":
            assert not re.search(r"/(lines|totals)-|/(lineitem|orders)\.parquet", plan(found)), name


def test_gold_lines_are_not_stored(retail):
    """Lines added up per order and product are nearly as many as the lines: the roll-ups are made from these themselves."""
    assert [f.rsplit("/", 1)[-1] for f in stored(retail).lines.df.inputFiles()] == ["lineitem.parquet"]


def test_gold_roll_ups_with_missing_and_repeated_keys(spark, tmp_path):
    for name in ("region", "nation", "customer", "part", "orders", "supplier"):
        os.symlink(f"{SF}/{name}.parquet", tmp_path / f"{name}.parquet")
    lines = spark.read.parquet(f"{SF}/lineitem.parquet")
    gone = {c: F.when(F.col("l_linenumber") != n, F.col(c)) for c, n in (("l_partkey", 2), ("l_orderkey", 3))}
    lines.unionByName(lines.withColumns(gone)).unionByName(lines.withColumn("l_partkey", F.col("l_partkey") + 1_000_000)).write.parquet(str(tmp_path / "lineitem.parquet"))
    odd = StarRetail(spark, str(tmp_path))
    kept = stored(odd)
    for name in ("revenue_per_product", "sales_by_category", "top_products", "daily_revenue", "new_vs_returning"):
        assert rows(metric(name, kept)) == rows(metric(name, odd)), name
