"""Dashboard statements: SQL text over the gold views."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame

from basketry.plans.metrics import METRICS, avg_delivery_time, metric
from basketry.plans.rfm import rfm_segments
from basketry.plans.roles import Retail, stored
from basketry.sources.lake import Lake, register_views

# statement name -> SQL; {p} is the prefix of the views or tables
DASHBOARDS: dict[str, str] = {
    "dash_daily_revenue": "SELECT * FROM {p}daily_revenue ORDER BY order_date",
    "top10_products": "SELECT * FROM {p}top_products ORDER BY revenue DESC, product_id LIMIT 10",
    "top10_clv": "SELECT * FROM {p}customer_lifetime_value ORDER BY lifetime_value DESC, customer_id LIMIT 10",
    "dash_average_order_value": "SELECT * FROM {p}average_order_value",
    "dash_payment_summary": "SELECT * FROM {p}payment_summary",
    "dash_monthly_revenue": "SELECT * FROM {p}monthly_revenue ORDER BY order_month",
    "dash_yearly_revenue": "SELECT * FROM {p}yearly_revenue ORDER BY order_year",
    "dash_revenue_by_category": "SELECT * FROM {p}revenue_by_category ORDER BY revenue DESC",
    "top15_cities": "SELECT * FROM {p}revenue_by_city ORDER BY revenue DESC, city LIMIT 15",
    "dash_revenue_by_state": "SELECT * FROM {p}revenue_by_state ORDER BY revenue DESC",
    "dash_new_vs_returning": "SELECT * FROM {p}new_vs_returning ORDER BY segment",
    "rfm_segment_counts": "SELECT segment, COUNT(*) AS customers FROM {p}rfm_segmentation GROUP BY segment ORDER BY customers DESC",
    "top10_customers": "SELECT * FROM {p}top_customers ORDER BY lifetime_value DESC, customer_id LIMIT 10",
    "bottom10_products": "SELECT * FROM {p}bottom_products ORDER BY revenue ASC, product_id LIMIT 10",
    "dash_sales_by_category": "SELECT * FROM {p}sales_by_category ORDER BY revenue DESC",
    "dash_orders_by_month": "SELECT * FROM {p}orders_by_month ORDER BY order_month",
    "dash_orders_by_weekday": "SELECT * FROM {p}orders_by_day ORDER BY day_num",
    "dash_payment_success_rate": "SELECT * FROM {p}payment_success_rate ORDER BY count DESC",
    "dash_revenue_by_payment_method": "SELECT * FROM {p}revenue_by_payment_method ORDER BY revenue DESC",
    "dash_delivery_performance": "SELECT * FROM {p}delivery_performance ORDER BY delivery_rate_pct DESC",
    "dash_late_deliveries": "SELECT * FROM {p}late_deliveries ORDER BY count DESC",
    "dash_shipping_status": "SELECT * FROM {p}shipping_status_distribution ORDER BY delivery_status, courier",
    "kpi_total_revenue": "SELECT ROUND(SUM(revenue), 2) AS total_revenue FROM {p}daily_revenue",
    "kpi_total_orders": "SELECT SUM(orders) AS total_orders FROM {p}daily_revenue",
    "dash_new_vs_returning_share": "SELECT * FROM {p}new_vs_returning",
    "dash_payment_health": "SELECT payment_status, count, pct_of_total FROM {p}payment_success_rate ORDER BY count DESC",
    "dash_delivery_health": "SELECT courier, total_shipments, delivered, delivery_rate_pct FROM {p}delivery_performance ORDER BY delivery_rate_pct DESC",
    # named as dashboard items
    "kpi_repeat_customer_rate": (
        "SELECT SUM(CASE WHEN segment = 'Returning' THEN customers ELSE 0 END) AS repeat_customers,"
        " SUM(customers) AS customers,"
        " ROUND(100.0D * SUM(CASE WHEN segment = 'Returning' THEN customers ELSE 0 END) / SUM(customers), 2) AS repeat_rate_pct"
        " FROM {p}new_vs_returning"
    ),
    "kpi_revenue_at_risk": "SELECT SUM(failed_count) AS failed_payments, ROUND(SUM(revenue_at_risk), 2) AS revenue_at_risk FROM {p}failed_payments",
    "late_by_courier": "SELECT courier, SUM(count) AS late FROM {p}late_deliveries GROUP BY courier ORDER BY late DESC, courier",
}

#: Gold tables written at the same time.
AT_A_TIME = 4

# gold tables whose name differs from their metric
GOLD_NAMES = {"orders_by_weekday": "orders_by_day"}


def gold_builders(retail: Retail, snapshot: dt.date | None = None, *, fanout: bool = False) -> dict[str, Callable[[], DataFrame]]:
    """Gold table name -> builder, all 28 of them."""
    builders = {
        GOLD_NAMES.get(name, name): (lambda n=name: metric(n, retail, fanout=fanout)) for name in METRICS
    }
    builders["rfm_segmentation"] = lambda: rfm_segments(retail, snapshot, fanout=fanout)
    builders["avg_delivery_time"] = lambda: avg_delivery_time(retail)
    return builders


def build_gold(
    lake: Lake, retail: Retail, snapshot: dt.date | None = None, *, fanout: bool = False, only: Iterable[str] | None = None,
) -> list[str]:
    """Write every gold table, or the ones named; returns the names of the written tables.

    What most tables come from is stored first (``roles.stored``): totals per order, and sales per day, customer, product and category. The tables do not depend on each other, so several are written at a time.
    """
    wanted = None if only is None else set(only)
    builders = gold_builders(stored(retail) if wanted is None else retail, snapshot, fanout=fanout)
    chosen = [name for name in builders if wanted is None or name in wanted]
    with ThreadPoolExecutor(AT_A_TIME) as pool:
        list(pool.map(lambda name: lake.overwrite(builders[name](), f"gold_{name}"), chosen))
    return [f"gold_{name}" for name in chosen]


def tables_in(statement: str) -> list[str]:
    """Gold tables a dashboard statement reads."""
    return re.findall(r"\{p\}(\w+)", statement)


def dashboard(lake: Lake, name: str, *, prefix: str = "vw_") -> DataFrame:
    """Run a statement over views of the stored gold tables."""
    statement = DASHBOARDS[name]
    register_views({t: lake.read(f"gold_{t}") for t in tables_in(statement)}, prefix)
    return lake.spark.sql(statement.format(p=prefix))
