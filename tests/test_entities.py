"""Metrics on the entity tables against plain joins, the definition of the figures."""

from __future__ import annotations

import datetime as dt
import re

import pytest
from conftest import rows
from pyspark.sql import functions as F

from basketry.functions.columns import to_event_date
from basketry.plans.dashboards import DASHBOARDS, build_gold, dashboard, gold_builders
from basketry.plans.metrics import METRICS, avg_delivery_time, metric
from basketry.plans.rfm import rfm_segments
from basketry.plans.roles import EntityRetail
from basketry.plans.sales import fanout_report, sales_table
from basketry.session import new_folder
from basketry.sources.lake import Lake

DAY = dt.datetime(2024, 5, 20, 12)


@pytest.fixture(scope="module")
def tables(spark):
    """Every awkward case: re-deliveries, ghosts, null and unreadable times, null amounts."""
    stamp = lambda n: DAY + dt.timedelta(minutes=n)
    orders = [
        # id, customer, product, quantity, amount, event time, city, state, message minute
        ("o1", "c1", "p1", 1.0, 100.0, "2024-05-18T10:00:00", "Pune", "Maharashtra", 0),
        ("o1", "c1", "p1", 1.0, 100.0, "2024-05-18T10:00:00", "Pune", "Maharashtra", 9),
        ("o2", "c1", "p2", 2.0, 50.25, "2024-05-19T23:59:59", "Delhi", "Delhi", 1),
        ("o3", "c2", "p1", 1.5, 10.005, "NaT", "Delhi", "Delhi", 2),
        ("o4", "c2", "p3", 1.0, -20.0, "", "Surat", "Gujarat", 3),
        ("o5", "CUSTOMER_ID_GHOST_1", "p2", 5.0, None, "2024-04-01T00:00:00", None, None, 4),
        ("o6", "c3", "PRODUCT_ID_GHOST_1", 1.0, 33.33, "not a date", "Pune", "Maharashtra", 5),
        ("o7", None, "p1", 2.0, 70.0, None, "Pune", "Maharashtra", 6),
        ("o8", "c4", None, 2.0, 70.0, "2023-12-31T00:00:00", "Pune", "Maharashtra", 7),
    ]
    customers = [
        ("c1", "Asha", 30.0, "Female", "Pune", 0), ("c1", "Asha", 30.0, "Female", "Poona", 5),
        ("c2", "Ravi", 999.0, "Male", "Delhi", 1), ("c3", "Kim", None, "Other", "Surat", 2),
        ("c4", "Lee", 41.0, "Male", None, 3),
    ]
    products = [
        ("p1", "Phone", "Electronics", "Acme", 100.0, 0), ("p1", "Phone", "electronics", "Acme", 100.0, 1),
        ("p2", "Chair", "Furniture", "Oak", 25.0, 2), ("p3", "Book", "Books", None, 20.0, 3),
    ]
    payments = [
        ("y1", "o1", "UPI", "Success", 100.0, 0), ("y1", "o1", "UPI", "Success", 100.0, 4), ("y2", "o2", "upi", "", 50.25, 1),
        ("y3", "o3", None, None, 10.0, 2), ("y4", "o4", "COD", "ERROR", -20.0, 3), ("y9", "GHOST", "COD", "Failed", 1.0, 3),
    ]
    shipping = [
        ("s1", "o1", "Ekart", "Delivered", 0), ("s2", "o2", "Ekart", "Pending", 1), ("s3", "o2", None, "Failed", 2),
        ("s4", "o3", "DTDC", "???", 3), ("s5", "GHOST", "DTDC", "", 4), ("s6", "o5", "DTDC", "Delivered", 6),
    ]
    make = lambda data, schema: spark.createDataFrame(
        [(*r[:-1], stamp(r[-1])) for r in data], schema + ", kafka_timestamp timestamp"
    )
    return {
        "orders": make(orders, "order_id string, customer_id string, product_id string, quantity double, amount double, event_time string, city string, state string"),
        "customers": make(customers, "customer_id string, name string, age double, gender string, city string"),
        "products": make(products, "product_id string, product_name string, category string, brand string, price double"),
        "payments": make(payments, "payment_id string, order_id string, payment_method string, payment_status string, amount double"),
        "shipping": make(shipping, "shipment_id string, order_id string, courier string, delivery_status string"),
    }


@pytest.fixture(scope="module")
def plain(tables):
    """The wide table by real joins, numbers as they come."""
    wide = sales_table(tables["orders"], tables["customers"], tables["products"], tables["payments"], tables["shipping"])
    return wide.withColumns({"day": to_event_date(wide), "c": F.col("amount").cast("decimal(20,8)")})


REVENUE = "cast(round(sum(c), 2) as double)"
UNITS = "sum(quantity)"
ORDERS = "count(distinct order_id)"
MEAN = "cast(round(avg(c), 2) as double)"
PRODUCT = "product_id, product_name, category, brand"

PLAIN = {
    "daily_revenue": f"SELECT day, {REVENUE}, count(*) FROM s GROUP BY ALL",
    "monthly_revenue": f"SELECT date_trunc('month', day), {REVENUE}, count(*) FROM s GROUP BY ALL",
    "yearly_revenue": f"SELECT year(day), {REVENUE}, count(*) FROM s GROUP BY ALL",
    "revenue_by_category": f"SELECT category, {REVENUE}, {ORDERS} FROM s GROUP BY ALL",
    "revenue_by_city": f"SELECT city, {REVENUE}, {ORDERS} FROM s GROUP BY ALL",
    "revenue_by_state": f"SELECT state, {REVENUE}, {ORDERS} FROM s GROUP BY ALL",
    "top_products": f"SELECT product_id, {UNITS}, {REVENUE} FROM s GROUP BY ALL",
    "bottom_products": f"SELECT {PRODUCT}, {UNITS}, {REVENUE} FROM s GROUP BY ALL",
    "units_sold": f"SELECT {PRODUCT}, {UNITS} FROM s GROUP BY ALL",
    "revenue_per_product": f"SELECT {PRODUCT}, {REVENUE}, {UNITS}, {ORDERS}, {MEAN} FROM s GROUP BY ALL",
    "sales_by_category": f"SELECT category, {REVENUE}, {UNITS}, {ORDERS}, count(distinct product_id) FROM s GROUP BY ALL",
    "customer_lifetime_value": f"SELECT customer_id, {REVENUE}, {ORDERS} FROM s GROUP BY ALL",
    "repeat_customers": f"SELECT customer_id, name, gender, customer_city, {ORDERS}, {REVENUE} FROM s GROUP BY ALL HAVING {ORDERS} > 1",
    "top_customers": f"SELECT customer_id, name, gender, age, customer_city, {REVENUE}, {ORDERS}, {MEAN} FROM s GROUP BY ALL",
    "average_order_value": f"SELECT {REVENUE} / count(c) FROM s",
    "order_trend": f"SELECT day, {ORDERS}, {REVENUE} FROM s GROUP BY ALL",
    "orders_by_weekday": f"SELECT dayofweek(day), date_format(day, 'EEEE'), {ORDERS}, {REVENUE} FROM s WHERE day IS NOT NULL GROUP BY ALL",
    "orders_by_month": f"SELECT date_format(day, 'yyyy-MM'), {ORDERS}, {REVENUE} FROM s GROUP BY ALL",
}


def by_joins(wide, name):
    return wide.sparkSession.sql(PLAIN[name].replace("FROM s", "FROM {s}"), s=wide)


@pytest.mark.parametrize("name", list(PLAIN))
def test_fanout_metric_equals_plain_joins(tables, plain, name):
    retail = EntityRetail(tables, unique=False)
    assert rows(metric(name, retail, fanout=True)) == rows(by_joins(plain, name))


@pytest.mark.parametrize("name", list(PLAIN))
def test_unique_metric_equals_joins_of_deduplicated_tables(tables, name):
    from basketry.contracts import PRIMARY_KEY
    from basketry.operators.cleaning import dedupe_by_key

    once = {n: dedupe_by_key(df, [PRIMARY_KEY[n]], ["kafka_timestamp"]) for n, df in tables.items()}
    wide = once["orders"].join(once["customers"].withColumnRenamed("city", "customer_city").select("customer_id", "name", "age", "gender", "customer_city"), "customer_id", "left")
    wide = wide.join(once["products"].drop("price", "kafka_timestamp"), "product_id", "left")
    wide = wide.withColumns({"day": to_event_date(wide), "c": F.col("amount").cast("decimal(20,8)")})
    assert rows(metric(name, EntityRetail(tables))) == rows(by_joins(wide, name))


def test_fanout_report_counts_what_the_joins_give(tables, plain):
    report = fanout_report(tables["orders"], [
        ("customers", tables["customers"], "customer_id"), ("products", tables["products"], "product_id"),
        ("payments", tables["payments"], "order_id"), ("shipping", tables["shipping"], "order_id"),
    ])
    steps = {r["joined"]: r["rows"] for r in report.collect()}
    assert steps["orders"] == 9
    assert steps["shipping"] == plain.count()


def test_fanout_report_keeps_no_table_of_all_keys(tables):
    sides = [("customers", tables["customers"], "customer_id"), ("payments", tables["payments"], "order_id"), ("shipping", tables["shipping"], "order_id")]
    plan = fanout_report(tables["orders"], sides)._jdf.queryExecution().executedPlan().toString()
    assert "keys=[customer_id" in plan and "keys=[order_id" in plan
    assert not re.search(r"keys=\[[^\]]*customer_id[^\]]*order_id", plan)
    assert rows(fanout_report(tables["orders"].limit(0), sides)) == [(0, "orders", 0), (1, "customers", 0), (2, "payments", 0), (3, "shipping", 0)]


def test_new_vs_returning(tables):
    # c1 has two orders, c2 two, c3, c4, the ghost and the null customer one each
    assert rows(metric("new_vs_returning", EntityRetail(tables))) == [("New", 4, 4), ("Returning", 2, 4)]


def test_failed_payments_take_null_and_empty_status(tables):
    failed = metric("failed_payments", EntityRetail(tables), ordered=True)
    assert rows(failed) == [(None, None, 1, 10.0), ("", "upi", 1, 50.25), ("ERROR", "COD", 1, -20.0), ("Failed", "COD", 1, 1.0)]


def test_payment_shares_sum_to_all(tables):
    shares = metric("payment_success_rate", EntityRetail(tables, unique=False))
    assert {r["payment_status"]: (r["count"], r["pct_of_total"]) for r in shares.collect()} == {
        "Success": (2, 33.33), "": (1, 16.67), None: (1, 16.67), "ERROR": (1, 16.67), "Failed": (1, 16.67),
    }


def test_payments_without_an_id_still_count(spark, tables):
    lost = tables["payments"].where("payment_id = 'y2'").withColumn("payment_id", F.lit(None).cast("string"))
    more = tables["payments"].unionByName(lost).unionByName(lost.withColumn("amount", F.lit(7.0)))
    before = metric("payment_success_rate", EntityRetail(tables)).agg(F.sum("count"), F.sum("total_amount")).first()
    after = metric("payment_success_rate", EntityRetail({**tables, "payments": more})).agg(F.sum("count"), F.sum("total_amount")).first()
    assert after[0] - before[0] == 2 and round(after[1] - before[1], 2) == 57.25


def test_payment_summary_without_status_is_a_total(tables):
    bare = {**tables, "payments": tables["payments"].drop("payment_status")}
    assert rows(metric("payment_summary", EntityRetail(bare, unique=False))) == [(6,)]


def test_delivery_performance(tables):
    got = rows(metric("delivery_performance", EntityRetail(tables)))
    assert got == [(None, 1, 0, 1, 0.0), ("DTDC", 3, 1, 0, 33.33), ("Ekart", 2, 1, 1, 50.0)]


def test_late_deliveries_and_status_distribution(tables):
    retail = EntityRetail(tables)
    assert rows(metric("late_deliveries", retail)) == [(None, "Failed", 1), ("Ekart", "Pending", 1)]
    assert len(rows(metric("shipping_status_distribution", retail))) == 6


def test_avg_delivery_time_drops_undated_orders(tables):
    # o1 2 days, o2 1 day twice, o5 49 days; o3 has no date, the ghost no order
    got = rows(avg_delivery_time(EntityRetail(tables)))
    assert got == [(None, 1.0, 1), ("DTDC", 49.0, 1), ("Ekart", 1.5, 2)]


def test_rfm_drops_undated_customers_and_scores(tables):
    got = rfm_segments(EntityRetail(tables), dt.date(2024, 6, 1))
    by_id = {r["customer_id"]: r for r in got.collect()}
    assert set(by_id) == {"c1", "CUSTOMER_ID_GHOST_1", "c4"}
    assert by_id["c1"]["recency_days"] == 13 and by_id["c1"]["frequency"] == 2 and by_id["c1"]["monetary"] == 150.25
    assert by_id["c1"]["segment"] == "Champions" and by_id["c1"]["rfm_score"] == 9
    assert "SinglePartition" not in got._jdf.queryExecution().executedPlan().toString()


def test_gold_tables_and_dashboards(spark, tables):
    retail = EntityRetail(tables)
    lake = Lake(spark, root=new_folder(spark, "gold-test"))
    names = build_gold(lake, retail, dt.date(2024, 6, 1))
    assert len(names) == 28 and len(set(names)) == 28
    counts = {r["table"]: r["rows"] for r in lake.counts(names).collect()}
    for name, build in gold_builders(retail, dt.date(2024, 6, 1)).items():
        if name in ("daily_revenue", "rfm_segmentation", "top_customers"):
            assert counts[f"gold_{name}"] == build().count()
    for name in DASHBOARDS:
        shown = dashboard(lake, name)
        assert all("/gold_" in f for f in shown.inputFiles())
        shown.collect()
    total = dashboard(lake, "kpi_total_revenue").first()[0]
    assert total == pytest.approx(sum(r["revenue"] for r in metric("daily_revenue", retail).collect() if r["revenue"] is not None))


def test_empty_tables_give_empty_results(spark, tables):
    empty = EntityRetail({n: df.limit(0) for n, df in tables.items()})
    for name in METRICS:
        if name == "average_order_value":
            assert rows(metric(name, empty)) == [(None,)]
        else:
            assert metric(name, empty).count() == 0
    assert rfm_segments(empty, dt.date(2024, 6, 1)).count() == 0
