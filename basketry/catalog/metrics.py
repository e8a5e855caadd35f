"""Metrics, segments and dashboards on the star tables."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.catalog.registry import query, register
from basketry.plans.dashboards import DASHBOARDS, build_gold, dashboard, gold_builders, tables_in
from basketry.plans.metrics import METRICS, avg_delivery_time, metric
from basketry.plans.rfm import rfm_segments, segment_sizes
from basketry.plans.roles import StarRetail
from basketry.plans.sales import fanout_report, sales_table
from basketry.session import new_folder, stage
from basketry.sources.lake import Lake, preview, register_views, stacked_counts

SNAPSHOT = dt.date(2001, 8, 2)

# ----- SQL side -------------------------------------------------------------------

LINES = """lines AS (
  SELECT l_orderkey AS order_id, l_partkey AS product_id, o_custkey AS customer_id,
         CAST(o_orderdate AS DATE) AS event_date, l_quantity AS quantity,
         CAST(l_extendedprice AS DECIMAL(18,6)) * (1 - CAST(l_discount AS DECIMAL(8,6))) AS amount,
         CAST(CAST(l_extendedprice AS DECIMAL(18,6)) * 1000000 AS HUGEINT) * CAST((1 - CAST(l_discount AS DECIMAL(8,6))) * 1000000 AS HUGEINT) AS units
  FROM lineitem LEFT JOIN orders ON o_orderkey = l_orderkey)"""
WIDE = """SELECT lines.*, c_name AS name, c_mktsegment AS gender, n_name AS customer_city, n_name AS city, r_name AS state,
         p_name AS product_name, p_type AS category, p_brand AS brand
  FROM lines LEFT JOIN customer ON c_custkey = customer_id LEFT JOIN nation ON n_nationkey = c_nationkey
  LEFT JOIN region ON r_regionkey = n_regionkey LEFT JOIN part ON p_partkey = product_id"""
UNIQUE = f"WITH {LINES}, sales AS ({WIDE})"
FANOUT = (
    f"WITH {LINES}, sales AS ({WIDE} LEFT JOIN orders pay ON pay.o_orderkey = order_id"
    " LEFT JOIN lineitem ship ON ship.l_orderkey = order_id)"
)
PAYMENTS = """WITH payments AS (
  SELECT o_orderkey AS order_id, o_orderpriority AS payment_method, CAST(o_totalprice AS DECIMAL(18,6)) AS amount,
         CAST(CAST(o_totalprice AS DECIMAL(18,6)) * 1000000 AS HUGEINT) * 1000000 AS units,
         CASE o_orderstatus WHEN 'F' THEN 'Failed' WHEN 'O' THEN 'Success' ELSE 'Pending' END AS payment_status FROM orders)"""
SHIPPING = """WITH shipping AS (
  SELECT l_orderkey AS order_id, s_name AS courier, CAST(l_shipdate AS DATE) AS message_date,
         CASE l_returnflag WHEN 'A' THEN 'Delivered' WHEN 'N' THEN 'Pending' WHEN 'R' THEN 'Failed' END AS delivery_status
  FROM lineitem LEFT JOIN supplier ON s_suppkey = l_suppkey)"""

REVENUE = "CAST(ROUND(SUM(amount), 2) AS DOUBLE)"
UNITS = "CAST(SUM(CAST(quantity AS DECIMAL(18,6))) AS DOUBLE)"
ORDERS = "COUNT(DISTINCT order_id)"
# the sum in units of 1e-12, so that the mean is rounded once
MEAN = "CAST((2 * SUM(units) + COUNT(amount) * 10000000000) // (2 * COUNT(amount) * 10000000000) AS DOUBLE) / 100"


def share(part: str, whole: str) -> str:
    return f"CAST((20000 * CAST({part} AS HUGEINT) + {whole}) // (2 * {whole}) AS DOUBLE) / 100"


_PRODUCT = "product_id, product_name, category, brand"

SALES_SQL: dict[str, str] = {
    "daily_revenue": f"SELECT event_date AS order_date, {REVENUE} AS revenue, COUNT(*) AS orders FROM sales GROUP BY 1",
    "monthly_revenue": f"SELECT CAST(date_trunc('month', event_date) AS TIMESTAMP) AS order_month, {REVENUE} AS revenue, COUNT(*) AS orders FROM sales GROUP BY 1",
    "yearly_revenue": f"SELECT CAST(year(event_date) AS INTEGER) AS order_year, {REVENUE} AS revenue, COUNT(*) AS orders FROM sales GROUP BY 1",
    "revenue_by_category": f"SELECT category, {REVENUE} AS revenue, {ORDERS} AS orders FROM sales GROUP BY 1",
    "revenue_by_city": f"SELECT city, {REVENUE} AS revenue, {ORDERS} AS orders FROM sales GROUP BY 1",
    "revenue_by_state": f"SELECT state, {REVENUE} AS revenue, {ORDERS} AS orders FROM sales GROUP BY 1",
    "top_products": f"SELECT product_id, {UNITS} AS units_sold, {REVENUE} AS revenue FROM sales GROUP BY 1",
    "bottom_products": f"SELECT {_PRODUCT}, {UNITS} AS units_sold, {REVENUE} AS revenue FROM sales GROUP BY ALL",
    "units_sold": f"SELECT {_PRODUCT}, {UNITS} AS units_sold FROM sales GROUP BY ALL",
    "revenue_per_product": f"SELECT {_PRODUCT}, {REVENUE} AS total_revenue, {UNITS} AS units_sold, {ORDERS} AS orders, {MEAN} AS avg_order_revenue FROM sales GROUP BY ALL",
    "sales_by_category": f"SELECT category, {REVENUE} AS revenue, {UNITS} AS units_sold, {ORDERS} AS orders, COUNT(DISTINCT product_id) AS products FROM sales GROUP BY 1",
    "customer_lifetime_value": f"SELECT customer_id, {REVENUE} AS lifetime_value, {ORDERS} AS orders FROM sales GROUP BY 1",
    "repeat_customers": f"SELECT customer_id, name, gender, customer_city, {ORDERS} AS order_count, {REVENUE} AS total_spend FROM sales GROUP BY ALL HAVING {ORDERS} > 1",
    "new_vs_returning": f"SELECT segment, COUNT(*) AS customers, CAST(SUM(order_count) AS BIGINT) AS total_orders FROM (SELECT customer_id, {ORDERS} AS order_count, CASE WHEN {ORDERS} = 1 THEN 'New' ELSE 'Returning' END AS segment FROM sales GROUP BY 1) GROUP BY 1",
    "top_customers": f"SELECT customer_id, name, gender, customer_city, {REVENUE} AS lifetime_value, {ORDERS} AS orders, {MEAN} AS avg_order_value FROM sales GROUP BY ALL",
    "average_order_value": f"SELECT {REVENUE} / COUNT(amount) AS average_order_value FROM sales",
    "order_trend": f"SELECT event_date AS order_date, {ORDERS} AS orders, {REVENUE} AS revenue FROM sales GROUP BY 1",
    "orders_by_weekday": f"SELECT CAST(dayofweek(event_date) + 1 AS INTEGER) AS day_num, dayname(event_date) AS day_name, {ORDERS} AS orders, {REVENUE} AS revenue FROM sales WHERE event_date IS NOT NULL GROUP BY 1, 2",
    "orders_by_month": f"SELECT strftime(event_date, '%Y-%m') AS order_month, {ORDERS} AS orders, {REVENUE} AS revenue FROM sales GROUP BY 1",
}

OTHER_SQL: dict[str, str] = {
    "payment_summary": f"{PAYMENTS} SELECT payment_status, COUNT(*) AS count FROM payments GROUP BY 1",
    "payment_success_rate": f"{PAYMENTS} SELECT payment_status, COUNT(*) AS count, {REVENUE} AS total_amount, "
    + share("COUNT(*)", "(SELECT COUNT(*) FROM payments)") + " AS pct_of_total FROM payments GROUP BY 1",
    "failed_payments": f"{PAYMENTS} SELECT payment_status, payment_method, COUNT(*) AS failed_count, {REVENUE} AS revenue_at_risk FROM payments"
    " WHERE payment_status IN ('Failed', 'ERROR', 'unknown_status') OR payment_status IS NULL OR payment_status = '' GROUP BY 1, 2",
    "revenue_by_payment_method": f"{PAYMENTS} SELECT payment_method, COUNT(*) AS transactions, {REVENUE} AS revenue, {MEAN} AS avg_transaction FROM payments GROUP BY 1",
    "delivery_performance": f"{SHIPPING} SELECT courier, COUNT(*) AS total_shipments, COUNT(*) FILTER (delivery_status = 'Delivered') AS delivered,"
    " COUNT(*) FILTER (delivery_status IN ('Pending', 'Failed')) AS pending_or_failed, "
    + share("COUNT(*) FILTER (delivery_status = 'Delivered')", "COUNT(*)") + " AS delivery_rate_pct FROM shipping GROUP BY 1",
    "late_deliveries": f"{SHIPPING} SELECT courier, delivery_status, COUNT(*) AS count FROM shipping WHERE delivery_status IN ('Pending', 'Failed') GROUP BY 1, 2",
    "shipping_status_distribution": f"{SHIPPING} SELECT delivery_status, courier, COUNT(*) AS shipments FROM shipping GROUP BY 1, 2",
}

DELIVERY_TIME_SQL = f"""{SHIPPING}, timed AS (
  SELECT courier, date_diff('day', CAST(o_orderdate AS DATE), message_date) AS days
  FROM shipping LEFT JOIN orders ON o_orderkey = order_id)
SELECT courier, CAST((20 * CAST(SUM(days) AS HUGEINT) + COUNT(*)) // (2 * COUNT(*)) AS DOUBLE) / 10 AS avg_days_to_process, COUNT(*) AS shipments
FROM timed WHERE days >= 0 GROUP BY 1"""


def rfm_sql(prefix: str) -> str:
    return f"""{prefix}, base AS (
  SELECT customer_id, CAST(date_diff('day', MAX(event_date), DATE '{SNAPSHOT}') AS INTEGER) AS recency_days,
         {ORDERS} AS frequency, ROUND(SUM(amount), 2) AS total, {REVENUE} AS monetary
  FROM sales GROUP BY 1 HAVING MAX(event_date) IS NOT NULL),
tiled AS (SELECT *,
  CAST(ntile(3) OVER (ORDER BY recency_days, md5(CAST(customer_id AS VARCHAR))) AS INTEGER) AS R,
  CAST(ntile(3) OVER (ORDER BY frequency, md5(CAST(customer_id AS VARCHAR))) AS INTEGER) AS F,
  CAST(ntile(3) OVER (ORDER BY total NULLS FIRST, md5(CAST(customer_id AS VARCHAR))) AS INTEGER) AS M FROM base),
rfm AS (SELECT customer_id, recency_days, frequency, monetary, R, F, M, 4 - R + F + M AS rfm_score FROM tiled),
segments AS (SELECT *, CASE WHEN rfm_score >= 8 THEN 'Champions' WHEN rfm_score >= 6 THEN 'Loyal'
  WHEN rfm_score >= 4 THEN 'Potential' ELSE 'At Risk' END AS segment FROM rfm)"""


RFM_SQL = rfm_sql(UNIQUE) + " SELECT * FROM segments"


# ----- metrics ----------------------------------------------------------------------


def _metric_runner(name: str, fanout: bool = False):
    return lambda spark, sf: metric(name, StarRetail(spark, sf), fanout=fanout, ordered=True)


for _name, _sql in SALES_SQL.items():
    register(_name, _metric_runner(_name), f"{UNIQUE} {_sql}")
    register(f"{_name}_fanout", _metric_runner(_name, fanout=True), f"{FANOUT} {_sql}")
for _name, _sql in OTHER_SQL.items():
    register(_name, _metric_runner(_name), _sql)


@query("avg_delivery_time", DELIVERY_TIME_SQL)
def _avg_delivery_time(spark, sf):
    return avg_delivery_time(StarRetail(spark, sf)).orderBy("avg_days_to_process", "courier")


@query("rfm_scores", RFM_SQL)
def _rfm_scores(spark, sf):
    return rfm_segments(StarRetail(spark, sf), SNAPSHOT)


@query("rfm_scores_by_cuts", RFM_SQL)
def _rfm_scores_by_cuts(spark, sf):
    """Scores written as a table and read back."""
    return stage(rfm_segments(StarRetail(spark, sf), SNAPSHOT), "rfm-scores")


@query("rfm_scores_fanout", rfm_sql(FANOUT) + " SELECT * FROM segments")
def _rfm_scores_fanout(spark, sf):
    return rfm_segments(StarRetail(spark, sf), SNAPSHOT, fanout=True)


# ----- dashboards ---------------------------------------------------------------------

# statement -> (SQL of the table it reads, what it selects from it)
_DASH_SQL: dict[str, tuple[str, str]] = {
    "dash_daily_revenue": ("daily_revenue", "SELECT * FROM t"),
    "top10_products": ("top_products", "SELECT * FROM t ORDER BY revenue DESC, product_id LIMIT 10"),
    "top10_clv": ("customer_lifetime_value", "SELECT * FROM t ORDER BY lifetime_value DESC, customer_id LIMIT 10"),
    "dash_average_order_value": ("average_order_value", "SELECT * FROM t"),
    "dash_payment_summary": ("payment_summary", "SELECT * FROM t"),
    "dash_monthly_revenue": ("monthly_revenue", "SELECT * FROM t"),
    "dash_yearly_revenue": ("yearly_revenue", "SELECT * FROM t"),
    "dash_revenue_by_category": ("revenue_by_category", "SELECT * FROM t"),
    "top15_cities": ("revenue_by_city", "SELECT * FROM t ORDER BY revenue DESC, city LIMIT 15"),
    "dash_revenue_by_state": ("revenue_by_state", "SELECT * FROM t"),
    "dash_new_vs_returning": ("new_vs_returning", "SELECT * FROM t"),
    "rfm_segment_counts": ("rfm", "SELECT segment, COUNT(*) AS customers FROM t GROUP BY 1"),
    "top10_customers": ("top_customers", "SELECT * FROM t ORDER BY lifetime_value DESC, customer_id LIMIT 10"),
    "bottom10_products": ("bottom_products", "SELECT * FROM t ORDER BY revenue, product_id LIMIT 10"),
    "dash_sales_by_category": ("sales_by_category", "SELECT * FROM t"),
    "dash_orders_by_month": ("orders_by_month", "SELECT * FROM t"),
    "dash_orders_by_weekday": ("orders_by_weekday", "SELECT * FROM t"),
    "dash_payment_success_rate": ("payment_success_rate", "SELECT * FROM t"),
    "dash_revenue_by_payment_method": ("revenue_by_payment_method", "SELECT * FROM t"),
    "dash_delivery_performance": ("delivery_performance", "SELECT * FROM t"),
    "dash_late_deliveries": ("late_deliveries", "SELECT * FROM t"),
    "dash_shipping_status": ("shipping_status_distribution", "SELECT * FROM t"),
    "kpi_total_revenue": ("daily_revenue", "SELECT ROUND(SUM(revenue), 2) AS total_revenue FROM t"),
    "kpi_total_orders": ("daily_revenue", "SELECT CAST(SUM(orders) AS BIGINT) AS total_orders FROM t"),
    "dash_new_vs_returning_share": ("new_vs_returning", "SELECT * FROM t"),
    "dash_payment_health": ("payment_success_rate", "SELECT payment_status, count, pct_of_total FROM t"),
    "dash_delivery_health": ("delivery_performance", "SELECT courier, total_shipments, delivered, delivery_rate_pct FROM t"),
    "kpi_repeat_customer_rate": (
        "new_vs_returning",
        "SELECT CAST(SUM(customers) FILTER (segment = 'Returning') AS BIGINT) AS repeat_customers, CAST(SUM(customers) AS BIGINT) AS customers,"
        " ROUND(100.0 * SUM(customers) FILTER (segment = 'Returning') / SUM(customers), 2)::DOUBLE AS repeat_rate_pct FROM t",
    ),
    "kpi_revenue_at_risk": (
        "failed_payments",
        "SELECT CAST(SUM(failed_count) AS BIGINT) AS failed_payments, ROUND(SUM(revenue_at_risk), 2) AS revenue_at_risk FROM t",
    ),
    "late_by_courier": ("late_deliveries", "SELECT courier, CAST(SUM(count) AS BIGINT) AS late FROM t GROUP BY 1"),
}


def table_sql(name: str) -> str:
    if name == "rfm":
        return RFM_SQL
    return f"{UNIQUE} {SALES_SQL[name]}" if name in SALES_SQL else OTHER_SQL[name]


def _dashboard(spark, sf, name):
    """Store the gold tables a statement reads, then run it over them."""
    lake = Lake(spark, root=new_folder(spark, "dashboard"))
    build_gold(lake, StarRetail(spark, sf), SNAPSHOT, only=tables_in(DASHBOARDS[name]))
    return dashboard(lake, name)


for _name in DASHBOARDS:
    _table, _pick = _DASH_SQL[_name]
    register(
        _name,
        lambda spark, sf, n=_name: _dashboard(spark, sf, n),
        f"WITH t AS ({table_sql(_table)}) {_pick}",
    )


# ----- gold tables and views -------------------------------------------------------------

_GOLD_SQL = {n: table_sql(n) for n in METRICS} | {"rfm_segmentation": RFM_SQL, "avg_delivery_time": DELIVERY_TIME_SQL}
_GOLD_SQL["orders_by_day"] = _GOLD_SQL.pop("orders_by_weekday")
GOLD_COUNTS_SQL = " UNION ALL ".join(
    f"SELECT 'gold_{name}' AS \"table\", COUNT(*) AS rows FROM ({sql})" for name, sql in _GOLD_SQL.items()
)


# gold table -> its key columns and the figures compared
GOLD_VALUES: dict[str, tuple[tuple[str, ...], tuple[str, ...]]] = {
    "daily_revenue": (("order_date",), ("revenue", "orders")),
    "monthly_revenue": (("order_month",), ("revenue", "orders")),
    "yearly_revenue": (("order_year",), ("revenue", "orders")),
    "revenue_by_category": (("category",), ("revenue", "orders")),
    "revenue_by_city": (("city",), ("revenue", "orders")),
    "revenue_by_state": (("state",), ("revenue", "orders")),
    "top_products": (("product_id",), ("units_sold", "revenue")),
    "bottom_products": (("product_id",), ("units_sold", "revenue")),
    "units_sold": (("product_id",), ("units_sold",)),
    "revenue_per_product": (("product_id",), ("total_revenue", "units_sold", "orders", "avg_order_revenue")),
    "sales_by_category": (("category",), ("revenue", "units_sold", "orders", "products")),
    "customer_lifetime_value": (("customer_id",), ("lifetime_value", "orders")),
    "repeat_customers": (("customer_id",), ("order_count", "total_spend")),
    "new_vs_returning": (("segment",), ("customers", "total_orders")),
    "rfm_segmentation": (("customer_id",), ("recency_days", "frequency", "monetary", "rfm_score")),
    "top_customers": (("customer_id",), ("lifetime_value", "orders", "avg_order_value")),
    "average_order_value": ((), ("average_order_value",)),
    "order_trend": (("order_date",), ("orders", "revenue")),
    "orders_by_day": (("day_num",), ("orders", "revenue")),
    "orders_by_month": (("order_month",), ("orders", "revenue")),
    "payment_summary": (("payment_status",), ("count",)),
    "payment_success_rate": (("payment_status",), ("count", "total_amount", "pct_of_total")),
    "failed_payments": (("payment_status", "payment_method"), ("failed_count", "revenue_at_risk")),
    "revenue_by_payment_method": (("payment_method",), ("transactions", "revenue", "avg_transaction")),
    "delivery_performance": (("courier",), ("total_shipments", "delivered", "pending_or_failed", "delivery_rate_pct")),
    "late_deliveries": (("courier", "delivery_status"), ("count",)),
    "avg_delivery_time": (("courier",), ("avg_days_to_process", "shipments")),
    "shipping_status_distribution": (("delivery_status", "courier"), ("shipments",)),
}


def _values_sql(name: str) -> str:
    keys, values = GOLD_VALUES[name]
    key = "concat_ws('|', " + ", ".join(["''", *[f"COALESCE(CAST({k} AS VARCHAR), '~')" for k in keys]]) + ")"
    listed = ", ".join(f"'{v}'" for v in values)
    figures = ", ".join(f'CAST("{v}" AS DOUBLE)' for v in values)
    return f"SELECT 'gold_{name}' AS \"table\", {key} AS key, unnest([{listed}]) AS \"column\", unnest([{figures}]) AS value FROM ({_GOLD_SQL[name]})"


@query("gold_build", " UNION ALL ".join(map(_values_sql, GOLD_VALUES)))
def _gold_build(spark, sf):
    """All 28 gold tables, two of them over stale ones of another schema: rows and columns are replaced."""
    lake, retail = Lake(spark, root=new_folder(spark, "gold")), StarRetail(spark, sf)
    for name in ("revenue_by_state", "yearly_revenue"):
        lake.overwrite(retail.customers.select("customer_id", F.lit("stale").alias("note")), f"gold_{name}")
    build_gold(lake, retail, SNAPSHOT)
    parts = []
    for name, (keys, values) in GOLD_VALUES.items():
        key = F.concat_ws("|", F.lit(""), *[F.coalesce(F.col(k).cast("string"), F.lit("~")) for k in keys])
        figures = F.array(*[F.struct(F.lit(v).alias("column"), F.col(v).cast("double").alias("value")) for v in values])
        parts.append(lake.read(f"gold_{name}").select(F.lit(f"gold_{name}").alias("table"), key.alias("key"), F.inline(figures)))
    return reduce(DataFrame.unionByName, parts)


@query("gold_row_counts", GOLD_COUNTS_SQL)
def _gold_row_counts(spark, sf):
    """Write all 28 tables, then count what was written."""
    lake = Lake(spark, root=new_folder(spark, "gold"))
    return lake.counts(build_gold(lake, StarRetail(spark, sf), SNAPSHOT))


@query("gold_views", GOLD_COUNTS_SQL.replace("'gold_", "'view_"))
def _gold_views(spark, sf):
    """Register all 28 views and count through them by name."""
    builders = gold_builders(StarRetail(spark, sf), SNAPSHOT)
    views = register_views({name: build() for name, build in builders.items()}, "view_")
    return stacked_counts({view: spark.table(view) for view in views})


# ----- the wide table --------------------------------------------------------------------


def star_sales(spark, sf, *, unique: bool = True):
    """Inputs of the wide table: orders, customers, products, payments, shipping."""
    retail = StarRetail(spark, sf)
    orders = retail.lines.attach(["customer_id", "event_time"]).df.drop("line_count", "priced")
    orders = orders.withColumns({"amount": F.col("exact_amount").cast("double"), "quantity": F.col("quantity").cast("double")}).drop("exact_amount")
    payments = retail.payments.df.select("payment_id", "order_id", "payment_method", "payment_status")
    shipping = retail.shipping.df.select("order_id", "courier_id", "delivery_status", "message_date")
    if unique:  # the latest shipment of each order
        shipping = shipping.groupBy("order_id").agg(
            F.max(F.struct("message_date", "courier_id", "delivery_status")).alias("s")
        ).select("order_id", "s.*")
    return orders, retail.customers, retail.products, payments, shipping


@query("sales_fact", f"""{UNIQUE}, last_ship AS (
  SELECT l_orderkey, max_by({{'c': l_suppkey, 's': CASE l_returnflag WHEN 'A' THEN 'Delivered' WHEN 'N' THEN 'Pending' WHEN 'R' THEN 'Failed' END, 'd': CAST(l_shipdate AS DATE)}},
    {{'d': CAST(l_shipdate AS DATE), 'c': l_suppkey, 's': CASE l_returnflag WHEN 'A' THEN 'Delivered' WHEN 'N' THEN 'Pending' WHEN 'R' THEN 'Failed' END}}) AS s
  FROM lineitem GROUP BY 1)
SELECT order_id, product_id, customer_id, event_date, quantity, CAST(amount AS DOUBLE) AS amount, name, gender, customer_city,
  product_name, category, brand, o_orderkey AS payment_id, o_orderpriority AS payment_method,
  CASE o_orderstatus WHEN 'F' THEN 'Failed' WHEN 'O' THEN 'Success' ELSE 'Pending' END AS payment_status,
  s.c AS courier_id, s.s AS delivery_status, s.d AS message_date
FROM sales LEFT JOIN orders ON o_orderkey = order_id LEFT JOIN last_ship ON l_orderkey = order_id""")
def _sales_fact(spark, sf):
    return sales_table(*star_sales(spark, sf), owners=StarRetail(spark, sf).owners).select(
        "order_id", "product_id", "customer_id", F.col("event_time").cast("date").alias("event_date"), "quantity", "amount",
        "name", "gender", "customer_city", "product_name", "category", "brand",
        "payment_id", "payment_method", "payment_status", "courier_id", "delivery_status", "message_date",
    )


@query("preview", f"""{UNIQUE} SELECT order_id, product_id, customer_id, quantity, CAST(amount AS DOUBLE) AS amount, name, product_name
FROM sales ORDER BY order_id, product_id, quantity, amount LIMIT 10""")
def _preview(spark, sf):
    """Ten rows of the wide table; only the columns shown are joined."""
    wide = StarRetail(spark, sf).lines.attach(["customer_id", "name", "product_name"]).df
    shown = wide.select(
        "order_id", "product_id", "customer_id", F.col("quantity").cast("double").alias("quantity"),
        F.col("exact_amount").cast("double").alias("amount"), "name", "product_name"
    )
    return preview(shown, 10, ["order_id", "product_id", "quantity", "amount"])


@query("sales_fanout_report", """WITH step0 AS (SELECT l_orderkey AS k, l_partkey AS p, o_custkey AS c FROM lineitem LEFT JOIN orders ON o_orderkey = l_orderkey),
step1 AS (SELECT k, p, c FROM step0 LEFT JOIN customer ON c_custkey = c), step2 AS (SELECT k, p FROM step1 LEFT JOIN part ON p_partkey = p),
step3 AS (SELECT k FROM step2 LEFT JOIN orders ON o_orderkey = k), step4 AS (SELECT k FROM step3 LEFT JOIN lineitem ON l_orderkey = k)
SELECT 0 AS step, 'orders' AS joined, COUNT(*) AS rows FROM step0 UNION ALL SELECT 1, 'customers', COUNT(*) FROM step1
UNION ALL SELECT 2, 'products', COUNT(*) FROM step2 UNION ALL SELECT 3, 'payments', COUNT(*) FROM step3
UNION ALL SELECT 4, 'shipping', COUNT(*) FROM step4""")
def _sales_fanout_report(spark, sf):
    orders, customers, products, payments, shipping = star_sales(spark, sf, unique=False)
    return fanout_report(orders, [
        ("customers", customers, "customer_id"), ("products", products, "product_id"),
        ("payments", payments, "order_id"), ("shipping", shipping, "order_id"),
    ], StarRetail(spark, sf).owners)


# Segment sizes straight from the scores, without a view.
@query("rfm_segment_sizes", rfm_sql(UNIQUE) + " SELECT segment, COUNT(*) AS customers FROM segments GROUP BY 1")
def _rfm_segment_sizes(spark, sf):
    return segment_sizes(rfm_segments(StarRetail(spark, sf), SNAPSHOT)).orderBy(F.desc("customers"))
