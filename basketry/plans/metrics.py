"""The 28 business metrics as records, and the one function that runs them.

Grouping is eager: when a key is an attribute of a lookup (say the city of a
customer) rows are first added up per lookup key, so the join sees one row per
key instead of the fact, whatever the skew. Only distinct order counts over
shared attributes need the join at row level.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.contracts import FAILED_PAYMENT_STATUSES, UNDELIVERED_STATUSES
from basketry.functions.columns import (
    mean_money, money, month_start, month_text, percent, rounded_ratio, weekday_name, weekday_number,
)
from basketry.operators.joins import left_lookup
from basketry.plans.roles import EXACT_MEASURES, SALES_MEASURES, Fact, Retail

# ----- measures -----------------------------------------------------------------
# A measure is built from parts that add up, so it can be computed in two steps.

PARTS: dict[str, Callable[[], Column]] = {
    "amount": lambda: F.sum("exact_amount"),
    "units": lambda: F.sum("quantity"),
    "rows": lambda: F.sum("line_count"),
    "priced": lambda: F.sum("priced"),
    "delivered": lambda: F.count_if(F.col("delivery_status") == "Delivered"),
    "undelivered": lambda: F.count_if(F.col("delivery_status").isin(*UNDELIVERED_STATUSES)),
    "shipments": lambda: F.count(F.lit(1)),
}


@dataclass(frozen=True)
class Measure:
    parts: tuple[str, ...]
    result: Callable[[], Column]


def _part(name: str) -> Column:
    return F.col(f"__{name}")


MEASURES: dict[str, Measure] = {
    "revenue": Measure(("amount",), lambda: money(_part("amount"))),
    "units": Measure(("units",), lambda: _part("units").cast("double")),
    "rows": Measure(("rows",), lambda: _part("rows")),
    "orders": Measure(("orders",), lambda: _part("orders")),
    "products": Measure(("products",), lambda: _part("products")),
    "mean": Measure(("amount", "priced"), lambda: money(_part("amount")) / F.when(_part("priced") > 0, _part("priced"))),
    "rounded_mean": Measure(("amount", "priced"), lambda: mean_money(_part("amount"), _part("priced"))),
    "shipments": Measure(("shipments",), lambda: _part("shipments")),
    "delivered": Measure(("delivered",), lambda: _part("delivered")),
    "undelivered": Measure(("undelivered",), lambda: _part("undelivered")),
    "delivered_percent": Measure(("delivered", "shipments"), lambda: percent(_part("delivered"), _part("shipments"))),
}

# keys computed from the event date
DATE_KEYS: dict[str, Callable[[Column], Column]] = {
    "order_date": lambda day: day,
    "order_month": month_start,
    "order_month_text": month_text,
    "order_year": lambda day: F.year(day),
    "day_num": weekday_number,
    "day_name": weekday_name,
}


@dataclass(frozen=True)
class Metric:
    name: str
    source: str  # sales | payments | shipping
    keys: tuple[str, ...]
    measures: Mapping[str, str]  # output column -> measure
    where: Callable[[], Column] | None = None
    having: Callable[[], Column] | None = None
    order: tuple[str, ...] = ()  # "-" prefix for descending
    rename: Mapping[str, str] = field(default_factory=dict)
    finish: Callable[[DataFrame, Fact], DataFrame] | None = None


def _group(fact: Fact, keys: list[str], parts: set[str]) -> DataFrame:
    """Fact grouped by ``keys`` with one ``__part`` column per part."""
    df = fact.df
    columns = []
    for part in sorted(parts):
        if part in fact.counted:
            one = F.coalesce(F.sum(f"{part}_count"), F.lit(0))
        elif part == "orders":
            one = F.count("order_id") if fact.order_unique else F.count_distinct("order_id")
        elif part == "products":
            one = F.count_distinct("product_id")
        else:
            one = PARTS[part]()
        columns.append(one.alias(f"__{part}"))
    return df.groupBy(*keys).agg(*columns) if keys else df.agg(*columns)


def _regroup(df: DataFrame, keys: list[str], parts: set[str]) -> DataFrame:
    return df.groupBy(*keys).agg(*[F.sum(f"__{p}").alias(f"__{p}") for p in sorted(parts)])


def _measure_parts(fact: Fact, keys: list[str], parts: set[str]) -> DataFrame:
    """Parts per key, joining lookups as late as the parts allow."""
    outside = [k for k in keys if fact.source_of(k) is not None]
    if not outside:
        return _group(fact, keys, parts)
    links = sorted({fact.via(k) for k in outside})
    inside = [k for k in keys if k not in outside]
    unique = all(fact.source_of(k).unique for k in outside)
    if len(links) == 1 and unique:
        link = links[0]
        first = sorted({link, *inside})
        unique_on = link if first == [link] else None
        if link in keys:  # the attributes hang on a key of the metric itself
            grouped = _group(fact, first, parts)
            return Fact(grouped, fact.lookups).attach(outside, unique_on).df
        additive = {p for p in parts if p not in ("orders", "products") or p in fact.counted or (p == "orders" and fact.order_unique)}
        if link == "product_id" and "products" in parts and first == [link]:
            additive.add("products")
        early = None
        if additive:
            base = _group(fact, first, additive - {"products"})
            if "products" in additive:
                base = base.withColumn("__products", F.when(F.col(link).isNotNull(), 1).otherwise(0))
            early = _regroup(Fact(base, fact.lookups).attach(outside, unique_on).df, keys, additive)
        rest = parts - additive
        if not rest:
            return early
        late_only = {"orders"} == rest and "products" not in parts
        if late_only or early is None:
            return _group(fact.attach(outside), keys, parts)
        # A second distinct count would multiply the rows shuffled; two narrow
        # passes joined on the few result keys do not.
        late = _group(fact.attach(outside), keys, rest)
        same = [early[k].eqNullSafe(late[k]) for k in keys]
        return early.join(late, same, "inner").select(
            *[early[k] for k in keys], *[f"__{p}" for p in sorted(parts)]
        )
    return _group(fact.attach(outside), keys, parts)


def run(metric: Metric, retail: Retail, *, fanout: bool = False, ordered: bool = False) -> DataFrame:
    """Result of ``metric``.

    ``fanout`` gives the figures plain left joins to customers, products,
    payments and shipping would give: every row counts once per match.
    """
    base = {k: "event_date" if k in DATE_KEYS else k for k in metric.keys}
    parts = {p for m in metric.measures.values() for p in MEASURES[m].parts}
    carrier = retail.lines if metric.source == "sales" else getattr(retail, metric.source)
    # A key the tables do not carry is left out of the grouping.
    keys = [k for k in metric.keys if carrier.has(base[k])]
    base_keys = [base[k] for k in keys]
    if metric.source != "sales":
        fact = carrier
    elif fanout:
        fact = weighted_sales(retail, base_keys)
    else:  # a grand total needs no order grain
        fact = retail.rolled(base_keys, parts) or (retail.sales(base_keys) if base_keys else retail.lines)
    if any(k in DATE_KEYS for k in keys):
        fact = fact.attach(["event_date"])
        fact = replace(fact, df=fact.df.withColumns({k: DATE_KEYS[k](F.col("event_date")) for k in keys if k in DATE_KEYS}))
    if metric.where is not None:
        fact = replace(fact, df=fact.df.where(metric.where()))
    grouped = _measure_parts(fact, keys, parts)
    result = grouped.select(
        *[F.col(k).alias(metric.rename.get(k, k)) for k in keys],
        *[MEASURES[m].result().alias(name) for name, m in metric.measures.items()],
    )
    if metric.having is not None:
        result = result.where(metric.having())
    if metric.finish is not None:
        result = metric.finish(result, fact)
    return sort(metric, result) if ordered else result


def sort(metric: Metric, result: DataFrame) -> DataFrame:
    """Display order. Stored tables skip it: it costs a shuffle and is not kept."""
    columns = [F.desc(c[1:]) if c.startswith("-") else F.asc(c) for c in metric.order]
    return result.orderBy(*columns) if columns else result


# ----- fan-out ------------------------------------------------------------------


def weighted_sales(retail: Retail, keys: list[str]) -> Fact:
    """Sales rows whose measures count once per match of the four joins.

    Instead of exploding the joins, matches are counted per key first and the
    measures multiplied, so the fact keeps its size.
    """
    start = retail.sales(keys)
    if any(not l.unique for l in start.lookups):
        start = retail.lines
    df = start.df
    weights = []
    per_order = start.order_unique
    for i, side in enumerate((retail.payments.df, retail.shipping.df)):
        counted = side.where(F.col("order_id").isNotNull()).groupBy("order_id").agg(F.count(F.lit(1)).alias(f"__w{i}"))
        df = df.join(counted, "order_id", "left") if per_order else left_lookup(df, counted, "order_id")
        weights.append(f"__w{i}")
    for i, lookup in enumerate(start.lookups, start=2):
        if lookup.unique:
            continue
        attributes = [k for k in keys if k in lookup.columns and k not in df.columns]
        counted = (
            lookup.table.where(F.col(lookup.key).isNotNull())
            .groupBy(lookup.key, *attributes).agg(F.count(F.lit(1)).alias(f"__w{i}"))
        )
        df = left_lookup(df, counted, lookup.key)
        weights.append(f"__w{i}")
    weight = F.lit(1).cast("bigint")
    for w in weights:
        weight = weight * F.coalesce(F.col(w), F.lit(1))
    df = df.withColumn("__weight", weight)
    # the products keep their scale: sums of a key times its matches have 26 digits before the point
    narrow = {m: F.col(m).cast("decimal(28,12)") if m in EXACT_MEASURES else F.col(m) for m in SALES_MEASURES}
    times = {m: F.col("__weight").cast("decimal(9,0)") if m in EXACT_MEASURES else F.col("__weight") for m in SALES_MEASURES}
    df = df.withColumns({m: narrow[m] * times[m] for m in SALES_MEASURES}).drop("__weight", *weights)
    duplicated = any(not l.unique for l in start.lookups)
    return replace(
        start, df=df, order_unique=start.order_unique and not duplicated,
        lookups=tuple(l for l in start.lookups if l.unique),
    )


# ----- finishing steps ------------------------------------------------------------


def _segment_by_orders(per_customer: DataFrame, _: Fact) -> DataFrame:
    segment = F.when(F.col("order_count") == 1, "New").otherwise("Returning")
    return per_customer.groupBy(segment.alias("segment")).agg(
        F.count(F.lit(1)).alias("customers"), F.sum("order_count").alias("total_orders")
    )


def _share_of_rows(per_status: DataFrame, fact: Fact) -> DataFrame:
    """Share of each group in all rows; the total is a scalar subquery, not a window."""
    total = fact.df.agg(F.sum("line_count")).scalar()
    return per_status.withColumn("pct_of_total", percent(F.col("count"), total))


def days_to_ship(retail: Retail) -> DataFrame:
    """Shipments with the days from order to shipping message, never negative."""
    dated = left_lookup(retail.shipping.df, retail.order_dates, "order_id")
    return dated.withColumn("days", F.datediff("message_date", "order_date")).where(F.col("days") >= 0)


def avg_delivery_time(retail: Retail) -> DataFrame:
    shipping = retail.shipping
    link = shipping.via("courier") or "courier"
    parts = days_to_ship(retail).groupBy(link).agg(
        F.sum(F.col("days").cast("bigint")).alias("__days"), F.count(F.lit(1)).alias("__shipments")
    )
    if link != "courier":
        parts = _regroup(Fact(parts, shipping.lookups).attach(["courier"], link).df, ["courier"], {"days", "shipments"})
    return parts.select(
        "courier",
        rounded_ratio(F.col("__days"), F.col("__shipments"), 1).alias("avg_days_to_process"),
        F.col("__shipments").alias("shipments"),
    )


# ----- the records ------------------------------------------------------------------

_PRODUCT = ("product_id", "product_name", "category", "brand")

METRICS: dict[str, Metric] = {m.name: m for m in (
    # revenue
    Metric("daily_revenue", "sales", ("order_date",), {"revenue": "revenue", "orders": "rows"}, order=("order_date",)),
    Metric("monthly_revenue", "sales", ("order_month",), {"revenue": "revenue", "orders": "rows"}, order=("order_month",)),
    Metric("yearly_revenue", "sales", ("order_year",), {"revenue": "revenue", "orders": "rows"}, order=("order_year",)),
    Metric("revenue_by_category", "sales", ("category",), {"revenue": "revenue", "orders": "orders"}, order=("-revenue",)),
    Metric("revenue_by_city", "sales", ("city",), {"revenue": "revenue", "orders": "orders"}, order=("-revenue",)),
    Metric("revenue_by_state", "sales", ("state",), {"revenue": "revenue", "orders": "orders"}, order=("-revenue",)),
    # products
    Metric("top_products", "sales", ("product_id",), {"units_sold": "units", "revenue": "revenue"},
           order=("-revenue", "product_id")),
    Metric("bottom_products", "sales", _PRODUCT, {"units_sold": "units", "revenue": "revenue"},
           order=("revenue", "product_id")),
    Metric("units_sold", "sales", _PRODUCT, {"units_sold": "units"}, order=("-units_sold", "product_id")),
    Metric("revenue_per_product", "sales", _PRODUCT,
           {"total_revenue": "revenue", "units_sold": "units", "orders": "orders", "avg_order_revenue": "rounded_mean"},
           order=("-total_revenue", "product_id")),
    Metric("sales_by_category", "sales", ("category",),
           {"revenue": "revenue", "units_sold": "units", "orders": "orders", "products": "products"}, order=("-revenue",)),
    # customers
    Metric("customer_lifetime_value", "sales", ("customer_id",), {"lifetime_value": "revenue", "orders": "orders"},
           order=("-lifetime_value", "customer_id")),
    Metric("repeat_customers", "sales", ("customer_id", "name", "gender", "customer_city"),
           {"order_count": "orders", "total_spend": "revenue"}, having=lambda: F.col("order_count") > 1,
           order=("-order_count", "customer_id")),
    Metric("new_vs_returning", "sales", ("customer_id",), {"order_count": "orders"}, finish=_segment_by_orders, order=("segment",)),
    Metric("top_customers", "sales", ("customer_id", "name", "gender", "age", "customer_city"),
           {"lifetime_value": "revenue", "orders": "orders", "avg_order_value": "rounded_mean"},
           order=("-lifetime_value", "customer_id")),
    # orders
    Metric("average_order_value", "sales", (), {"average_order_value": "mean"}),
    Metric("order_trend", "sales", ("order_date",), {"orders": "orders", "revenue": "revenue"}, order=("order_date",)),
    Metric("orders_by_weekday", "sales", ("day_num", "day_name"), {"orders": "orders", "revenue": "revenue"},
           where=lambda: F.col("event_date").isNotNull(), order=("day_num",)),
    Metric("orders_by_month", "sales", ("order_month_text",), {"orders": "orders", "revenue": "revenue"},
           rename={"order_month_text": "order_month"}, order=("order_month",)),
    # payments
    Metric("payment_summary", "payments", ("payment_status",), {"count": "rows"}),
    Metric("payment_success_rate", "payments", ("payment_status",), {"count": "rows", "total_amount": "revenue"},
           finish=_share_of_rows, order=("-count", "payment_status")),
    Metric("failed_payments", "payments", ("payment_status", "payment_method"),
           {"failed_count": "rows", "revenue_at_risk": "revenue"},
           where=lambda: F.col("payment_status").isin(*FAILED_PAYMENT_STATUSES)
           | F.col("payment_status").isNull() | (F.col("payment_status") == ""),
           order=("-failed_count", "payment_method")),
    Metric("revenue_by_payment_method", "payments", ("payment_method",),
           {"transactions": "rows", "revenue": "revenue", "avg_transaction": "rounded_mean"}, order=("-revenue",)),
    # shipping
    Metric("delivery_performance", "shipping", ("courier",),
           {"total_shipments": "shipments", "delivered": "delivered", "pending_or_failed": "undelivered",
            "delivery_rate_pct": "delivered_percent"}, order=("-delivery_rate_pct", "courier")),
    Metric("late_deliveries", "shipping", ("courier", "delivery_status"), {"count": "shipments"},
           where=lambda: F.col("delivery_status").isin(*UNDELIVERED_STATUSES), order=("-count", "courier", "delivery_status")),
    Metric("shipping_status_distribution", "shipping", ("delivery_status", "courier"), {"shipments": "shipments"},
           order=("delivery_status", "courier")),
)}


def metric(name: str, retail: Retail, *, fanout: bool = False, ordered: bool = False) -> DataFrame:
    return run(METRICS[name], retail, fanout=fanout, ordered=ordered)
