"""The wide sales table and what plain joins do to its row count."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.operators.joins import Owner, add_new_columns, left_lookup

CUSTOMER_COLUMNS = ("name", "age", "gender", "customer_city")
PRODUCT_COLUMNS = ("product_name", "category", "brand")


def sales_table(
    orders: DataFrame,
    customers: DataFrame,
    products: DataFrame,
    payments: DataFrame,
    shipping: DataFrame,
    owners: Iterable[Owner] = (),
) -> DataFrame:
    """Orders with customer, product, payment and shipping columns (left joins).

    A payment or shipping column that the left side already has keeps the left
    value. Rows multiply when a right side repeats a key; pass sides that hold
    one row per key to keep one row per order. ``owners`` gives stored tables with the order's keys, to look
    for hot ones in.
    """
    if "customer_city" not in customers.columns:
        customers = customers.withColumnRenamed("city", "customer_city")
    who = [c for c in CUSTOMER_COLUMNS if c in customers.columns]
    what = [c for c in PRODUCT_COLUMNS if c in products.columns]
    # The sides that share the order key come first, so that they share its shuffle.
    # Spark splits a hot order there; the hot keys of the others are looked for in the table that owns them.
    sales = add_new_columns(orders, payments, "order_id", taken=[*who, *what])
    sales = add_new_columns(sales, shipping, "order_id", taken=[*who, *what])
    for key, table in (("customer_id", customers.select("customer_id", *who)), ("product_id", products.select("product_id", *what))):
        owner = next((o for o in owners if key in o), None)
        sales = left_lookup(sales, table, key, keys_from=owner, spread=owner is not None, spot=["order_id", key])
    return sales


def fanout_report(
    orders: DataFrame,
    sides: list[tuple[str, DataFrame, str]],
    owners: Iterable[Owner] = (),
) -> DataFrame:
    """(step, joined, rows): rows after each plain left join, without running the joins.

    Matches are counted per key and multiplied. ``sides`` are (name, table,
    key) in join order. Orders are not grouped first: few share all keys, and a table of their keys
    would fill a task's memory. ``owners`` as in ``sales_table``.
    """
    steps: dict[str, list[tuple[int, DataFrame]]] = {}
    for step, (_, table, key) in enumerate(sides, start=1):
        steps.setdefault(key, []).append((step, table.where(F.col(key).isNotNull()).select(key, F.lit(step).alias("__step"))))
    packed = orders.select(*sorted(steps))
    # Sides that share a key are counted in one table; the key most sides share goes first.
    for key, tables in sorted(steps.items(), key=lambda item: -len(item[1])):
        matches = reduce(DataFrame.unionByName, [marked for _, marked in tables]).groupBy(key).agg(
            *[F.count_if(F.col("__step") == step).alias(f"__m{step}") for step, _ in tables])
        owner = next((o for o in owners if key in o), None)
        packed = left_lookup(packed, matches, key, keys_from=owner, spread=owner is not None)
    product, totals = F.lit(1).cast("bigint"), [F.count(F.lit(1)).alias("rows_0")]
    for step in range(1, len(sides) + 1):
        product = product * F.greatest(F.col(f"__m{step}"), F.lit(1))  # null without any match
        totals.append(F.coalesce(F.sum(product), F.lit(0)).alias(f"rows_{step}"))
    names = ["orders", *[name for name, _, _ in sides]]
    report = F.array(*[
        F.struct(F.lit(i).alias("step"), F.lit(name).alias("joined"), F.col(f"rows_{i}").alias("rows"))
        for i, name in enumerate(names)
    ])
    return packed.agg(*totals).select(F.inline(report))
