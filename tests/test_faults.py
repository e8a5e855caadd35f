from __future__ import annotations

import datetime as dt

import pytest
from conftest import rows
from pyspark.sql import functions as F

from basketry.catalog import REGISTRY
from basketry.contracts import BAD_PAYMENT_STATUSES, CITY_SPELLINGS, FAULT_SHARES, PRODUCT_CATALOG
from basketry.functions.columns import draw, steps, weighted
from basketry.operators import faults, quality, synth
from basketry.operators.cleaning import canonicalize, dedupe_by_key
from basketry.session import stage
from basketry.sources import files
from basketry.streaming.ingest import late_flag

TODAY = dt.date(2024, 6, 1)


@pytest.fixture(scope="module")
def tables(spark):
    return {n: stage(df, n) for n, df in synth.standalone(spark, 200, 4000, TODAY).items()}


def test_synthetic_tables_are_correlated(tables):
    sold, items, people = tables["orders"], tables["products"], tables["customers"]
    assert sold.count() == 4000 and people.count() == 200 and items.count() == len(PRODUCT_CATALOG)
    priced = sold.join(items.select("product_id", "low", "high"), "product_id")
    assert priced.count() == 4000 and priced.where("price < low OR price > high").count() == 0
    at_home = sold.join(people.select("customer_id", F.col("city").alias("home")), "customer_id")
    share = at_home.where("city = home").count() / at_home.count()
    assert 0.83 < share < 0.90  # 85 % stay, a few of the others land there too
    assert sold.where("event_time < timestamp'2024-02-01' OR event_time >= timestamp'2024-06-02'").count() == 0
    assert sold.where("coupon_code IS NOT NULL").count() == 0
    evening = sold.where(F.hour("event_time").between(18, 21)).count() / 4000
    assert 0.27 < evening < 0.34
    assert tables["payments"].select("order_id").distinct().count() == 4000
    refunded = tables["payments"].join(sold.select("order_id", "order_status"), "order_id").where("order_status = 'Returned'")
    assert {r[0] for r in refunded.select("payment_status").distinct().collect()} == {"Refunded", "Success"}
    shipped = tables["shipping"].join(sold.select("order_id", "order_status"), "order_id")
    assert shipped.where("order_status = 'Delivered' AND delivery_status <> 'Delivered'").count() == 0


def test_coupons_start_with_their_version(spark):
    keys = spark.range(9_000, 12_000)
    items, people = synth.catalog_products(spark), synth.customers(spark.range(1, 50), "id", TODAY)
    sold = synth.orders(keys, "id", F.lit("CUST000001"), F.lit("PROD0001"), people, items, TODAY)
    assert sold.where("order_seq < 10000 AND coupon_code IS NOT NULL").count() == 0
    share = sold.where("coupon_code IS NOT NULL").count() / 2000
    assert 0.26 < share < 0.34
    text = files.versioned_json(sold, "coupon_code", F.col("order_seq") >= 10_000)
    report = quality.field_version_report(sold.select("order_seq", text.alias("value")), "coupon_code", F.col("order_seq") >= 10_000)
    assert {r["version"]: (r["messages"], r["with_field"]) for r in report.collect()} == {"before": (1000, 0), "after": (2000, 2000)}


def test_weighted_shares(spark):
    picked = spark.range(20_000).select(weighted({"a": 3, "b": 1}, draw("w", F.col("id"))).alias("x"))
    assert abs(picked.where("x = 'a'").count() / 20_000 - 0.75) < 0.01
    assert steps(0.5) == 1 << 27


def test_copies_are_undone_by_key(tables):
    sold = tables["orders"]
    copied = faults.add_copies(sold, "order_seq", 0.03, scatter=True)
    extra = copied.count() - 4000
    assert 80 < extra < 160
    assert rows(dedupe_by_key(copied.drop("copy_no"), ["order_seq"], ["event_time"])) == rows(sold)


def test_misspelling_is_undone_by_the_dictionary(tables):
    sold = tables["orders"]
    spelt = faults.misspell(sold, "order_seq", "city", CITY_SPELLINGS, 0.5)
    assert spelt.join(sold.select("order_seq", F.col("city").alias("was")), "order_seq").where("city <> was").count() > 500
    assert rows(canonicalize(spelt, "city", CITY_SPELLINGS), "order_seq", "city") == rows(sold, "order_seq", "city")


def test_faults_do_not_depend_on_the_partitioning(tables):
    sold, now = tables["orders"], F.lit("2024-06-01").cast("timestamp")
    assert rows(faults.messy_orders(sold, "order_seq", now)) == rows(faults.messy_orders(sold.repartition(5), "order_seq", now))


def test_copies_are_hit_independently(tables):
    messy = faults.messy_orders(tables["orders"], "order_seq", F.lit("2024-06-01").cast("timestamp"), {**FAULT_SHARES, "duplicate": 1.0, "null": 0.5})
    pairs = messy.groupBy("order_seq").agg(F.count("discount").alias("filled"))
    assert pairs.where("filled = 1").count() > 1500


def test_reported_shares_match_the_configured_ones(tables):
    now = F.lit("2024-06-01 23:59:59").cast("timestamp")
    messy = stage(faults.messy_orders(tables["orders"], "order_seq", now), "messy")
    n = messy.count()
    nulls = {r["column"]: r["nulls"] / n for r in quality.null_report({"orders": (messy, ["discount", "payment_method", "missing"])}).collect()}
    assert set(nulls) == {"discount", "payment_method"}
    assert all(abs(v - FAULT_SHARES["null"]) < 0.015 for v in nulls.values())
    duplicates = quality.duplicate_report({"orders": (messy, ["order_seq"])}).first()["duplicates"]
    assert abs(duplicates / 4000 - FAULT_SHARES["duplicate"]) < 0.01
    late = quality.late_report(messy, F.col("is_late_arrival")).first()
    assert abs(late["late"] / n - FAULT_SHARES["late"]) < 0.01
    rules = {r["rule"]: r["violations"] for r in quality.rule_report({"orders": messy}, "timestamp'2024-06-01 23:59:59'").collect()}
    broken = sum(rules[r] for r in ("quantity_negative", "price_negative", "event_time_in_future"))
    assert abs(broken / n - FAULT_SHARES["invalid"] * 3 / 4) < 0.01
    outlying = sum(rules[r] for r in ("amount_above_million", "quantity_above_100", "discount_above_100"))
    assert abs(outlying / n - FAULT_SHARES["outlier"]) < 0.01
    orphans = quality.reference_report([
        ("orders", messy, "customer_id", "customers", tables["customers"], "customer_id"),
        ("orders", messy, "product_id", "products", tables["products"], "product_id"),
    ]).collect()
    assert all(abs(r["orphans"] / n - FAULT_SHARES["ghost"]) < 0.008 for r in orphans)


def test_other_entities_take_their_faults(tables):
    customers = faults.messy_customers(tables["customers"], "customer_id")
    assert customers.where("email IS NULL").count() > 0
    payments = faults.messy_payments(tables["payments"], "order_seq")
    assert payments.where("order_id LIKE 'ORDER_ID_GHOST_%'").count() > 0
    assert payments.where("amount < 0").count() > 0
    shipping = faults.messy_shipping(tables["shipping"], "order_seq")
    assert shipping.where("courier IS NULL").count() > 0
    assert shipping.where("delivery_status IN ('LOST_IN_SYSTEM', '???', '')").count() > 0
    from basketry.contracts import CATEGORY_SPELLINGS

    products = faults.messy_products(tables["products"], "product_id", CATEGORY_SPELLINGS, {"null": 0.5, "spelling": 0.5})
    assert products.where("description IS NULL").count() > 0


def test_rules_coerce_text(spark):
    df = spark.createDataFrame(
        [("-5", "abc", "2999-01-01"), ("7", "-1", "NaT"), (None, None, None)], "quantity string, price string, event_time string"
    )
    df = df.withColumns({"amount": F.lit(2e6), "discount": F.lit("150")})
    typed = quality.coerced(df, ["quantity", "price", "amount", "discount"], ["event_time"])
    got = {r["rule"]: r["violations"] for r in quality.rule_report({"orders": typed}, "timestamp'2024-06-01'").collect()}
    assert got == {
        "quantity_negative": 1, "price_negative": 1, "event_time_in_future": 1,
        "amount_above_million": 3, "quantity_above_100": 0, "discount_above_100": 3,
    }


def test_late_flag(spark):
    df = spark.sql("SELECT timestamp'2024-01-01' AS e, explode(array(timestamp'2024-01-01 23:59:59', timestamp'2024-01-02', NULL)) AS i")
    assert [r[0] for r in df.select(late_flag(F.col("e"), F.col("i"))).collect()] == [False, True, False]


def test_empty_tables_are_reported_as_such(spark):
    empty = spark.createDataFrame([], "order_seq int, discount double")
    assert rows(quality.null_report({"orders": (empty, ["discount"])})) == [("orders", "discount", 0, 0, None)]
    assert rows(quality.duplicate_report({"o": (empty, ["order_seq"])})) == [("o", 0, 0)]
    assert rows(quality.late_report(empty, F.lit(True))) == [(0, 0, None)]


def test_invalid_payments_are_made_from_drawn_orders(spark, tmp_path):
    """One payment a distinct order, amount and status from the drawn order; only a share of them is spoilt."""
    sf = str(tmp_path)
    spark.range(1, 40).select(F.col("id").alias("c_custkey")).write.parquet(f"{sf}/customer.parquet")
    customer = F.when(F.col("id") % 50 > 0, F.col("id") % 39 + 1)
    keys = spark.range(1, 4001).select(
        F.col("id").alias("o_orderkey"), customer.alias("o_custkey"), F.lit("O").alias("o_orderstatus"), F.lit(1.0).alias("o_totalprice"),
        F.lit("5-LOW").alias("o_orderpriority"))
    keys.union(keys.where("o_orderkey % 100 = 1")).write.parquet(f"{sf}/orders.parquet")

    got = {r["order_seq"]: r for r in REGISTRY["fault_invalid_payments"].run(spark, sf).collect()}
    orders = {r["order_seq"]: r for r in REGISTRY["synth_orders"].run(spark, sf).collect()}
    payments = {r["order_seq"]: r for r in REGISTRY["synth_payments"].run(spark, sf).collect()}
    assert REGISTRY["fault_invalid_payments"].run(spark, sf).count() == 4000 and set(got) == set(orders) == set(payments)
    spoilt = {"payment_status": 0, "amount": 0}
    for seq, r in got.items():
        assert abs(r["amount"]) == orders[seq]["amount"]
        changed = [c for c in spoilt if r[c] != payments[seq][c]]
        assert changed in ([], ["payment_status"], ["amount"])
        for c in changed:
            spoilt[c] += 1
        assert r["payment_status"] in (BAD_PAYMENT_STATUSES if changed == ["payment_status"] else ("Success", "Pending", "Failed", "Refunded"))
    assert min(spoilt.values()) > 20 and 50 < sum(spoilt.values()) < 120
    statuses = {s: {got[seq]["payment_status"] for seq in got if orders[seq]["order_status"] == s} - set(BAD_PAYMENT_STATUSES) for s in ("Returned", "Cancelled")}
    assert statuses == {"Returned": {"Refunded", "Success"}, "Cancelled": {"Refunded", "Failed", "Success"}}
