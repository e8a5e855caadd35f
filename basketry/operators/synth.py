"""Correlated retail columns drawn from row keys.

Every function takes a table of keys, so the output grows with it: keys of
real tables, or ``spark.range`` for stand-alone test data. All draws depend
on the key only; two runs, or two attempts of a task, give the same rows.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.contracts import (
    AGES, CITY_STATE, COUNTRY, COUPON_SHARE, COUPON_VERSION_START, COUPONS, COURIERS, DEFAULT_STATE,
    DELIVERY_OUTCOMES, DISCOUNTS, GENDERS, HOURS, ORDER_STATUSES, ORDER_WINDOW_DAYS, PAYMENT_METHODS,
    PAYMENT_OUTCOMES, PRODUCT_CATALOG, QUANTITIES, SAME_CITY_SHARE, SIGNUP_WINDOW_DAYS,
)
from basketry.functions.columns import chosen, draw, draw_below, draw_between, id_text, padded_id, pick, weighted
from basketry.operators.cleaning import dedupe_by_key, lookup_literal
from basketry.operators.joins import left_lookup

CITIES = list(CITY_STATE)


def outcome(given: Column, table: Mapping[str, Mapping[str, float]], drawn: Column) -> Column:
    """Weighted choice whose weights depend on another column; "*" is the default."""
    chain = None
    for value, weights in table.items():
        if value == "*":
            continue
        matches = given == value
        chain = F.when(matches, weighted(weights, drawn)) if chain is None else chain.when(matches, weighted(weights, drawn))
    return chain.otherwise(weighted(table["*"], drawn))


def catalog_products(spark: SparkSession) -> DataFrame:
    """The fixed product list with ids, mid-range price, price range and description."""
    columns = dict(zip(("product_name", "category", "brand", "low", "high"), zip(*PRODUCT_CATALOG)))
    # an Arrow table becomes a local relation of known size, so joins broadcast it
    listed = spark.createDataFrame(pa.table({"seq": range(1, len(PRODUCT_CATALOG) + 1), **columns}))
    return listed.select(
        padded_id("PROD", F.col("seq"), 4).alias("product_id"), "product_name", "category", "brand",
        ((F.col("low") + F.col("high")) / 2).alias("price"),
        F.concat(F.col("brand"), F.lit(" "), F.col("product_name"), F.lit(" - "), F.col("category"), F.lit(" category product.")).alias("description"),
        "low", "high",
    )


def customers(keys: DataFrame, key: str, today: dt.date) -> DataFrame:
    """One customer per key; numbers start at 1."""
    k = F.col(key)
    signup = F.date_sub(F.lit(today), draw_between(0, SIGNUP_WINDOW_DAYS, "signup", k).cast("int"))
    number = padded_id("", k, 6)
    return keys.select(
        padded_id("CUST", k, 6).alias("customer_id"),
        F.concat(F.lit("Customer "), number).alias("name"),
        draw_between(*AGES, "age", k).alias("age"),
        weighted(GENDERS, draw("gender", k)).alias("gender"),
        pick(CITIES, "city", k).alias("city"),
        signup.alias("signup_date"),
        F.format_string("+91%010d", draw_below(1 << 33, "phone", k)).alias("phone"),
        F.concat(F.lit("customer"), number, F.lit("@example.org")).alias("email"),
    )


def products(keys: DataFrame, key: str, name: str, brand: str, price: str) -> DataFrame:
    """Products for rows that bring name, brand and price: id, category and description are added.

    ``low`` and ``high`` span 80 % to 120 % of the price, in whole units.
    """
    k = F.col(key)
    category = pick(sorted({c for _, c, _, _, _ in PRODUCT_CATALOG}), "category", k)
    cents = F.rint(F.col(price) * 100).cast("bigint")
    return keys.select(
        padded_id("PROD", k, 4).alias("product_id"), F.col(name).alias("product_name"), category.alias("category"),
        F.col(brand).alias("brand"), F.col(price).alias("price"),
        F.concat(F.col(brand), F.lit(" "), F.col(name), F.lit(" - "), category, F.lit(" category product.")).alias("description"),
        F.floor(cents * 8 / 1000).cast("int").alias("low"),
        F.ceil(cents * 12 / 1000).cast("int").alias("high"),
    )


def order_amount(price: Column, quantity: Column, discount: Column) -> Column:
    """price x quantity less a percentage, rounded half up to cents."""
    hundredths = F.rint(price * 100).cast("bigint") * quantity * (F.lit(100) - discount)
    return F.floor((hundredths + 50) / 100) / 100


def orders(
    keys: DataFrame,
    key: str,
    customer: Column,
    product: Column,
    customer_table: DataFrame,
    product_table: DataFrame,
    today: dt.date,
) -> DataFrame:
    """One order per key for the given customer and product ids.

    Unit price lies in the product's range, the city is mostly the customer's,
    times favour the evening, and ``coupon_code`` exists from the version
    start on.
    """
    k = F.col(key)
    base = keys.select(k.cast("bigint").alias("order_seq"), customer.alias("customer_id"), product.alias("product_id"))
    seq = F.col("order_seq")
    sides = left_lookup(base, product_table.select("product_id", "low", "high"), "product_id")
    sides = left_lookup(sides, customer_table.select("customer_id", F.col("city").alias("home")), "customer_id", keys_from=base)

    # a weighted choice compares its draw many times, so draws are columns first
    drawn = {f"__{d}": draw(d, seq) for d in ("quantity", "discount", "payment-method", "order-status", "hour")}
    span = (F.col("high") - F.col("low")) * 100
    price_cents = F.col("low") * 100 + F.shiftright(draw("price", seq) * span, 28)
    stays = chosen(SAME_CITY_SHARE, "stays", seq) & F.col("home").isNotNull()
    city = F.when(stays, F.col("home")).otherwise(pick(CITIES, "order-city", seq))
    seconds = draw_between(0, 3599, "second", seq)
    day = F.date_sub(F.lit(today), draw_between(0, ORDER_WINDOW_DAYS, "day", seq).cast("int"))
    hour = weighted(HOURS, F.col("__hour"))
    coupon = F.when(
        (seq >= COUPON_VERSION_START) & chosen(COUPON_SHARE, "coupon", seq), pick(COUPONS, "coupon-code", seq)
    )
    return (
        sides.withColumns(drawn)
        .withColumns({"price": price_cents / 100, "quantity": weighted(QUANTITIES, F.col("__quantity")),
                      "discount": weighted(DISCOUNTS, F.col("__discount")), "city": city})
        .select(
            "order_seq", id_text("order", seq).alias("order_id"), "customer_id", "product_id", "quantity", "price", "discount",
            weighted(PAYMENT_METHODS, F.col("`__payment-method`")).alias("payment_method"),
            weighted(ORDER_STATUSES, F.col("`__order-status`")).alias("order_status"),
            "city", lookup_literal(F.col("city"), CITY_STATE, DEFAULT_STATE).alias("state"), F.lit(COUNTRY).alias("country"),
            (day.cast("timestamp") + F.make_dt_interval(hours=hour, secs=seconds.cast("int"))).alias("event_time"),
            order_amount(F.col("price"), F.col("quantity"), F.col("discount")).alias("amount"),
            coupon.alias("coupon_code"),
        )
    )


def _one_per_order(order_table: DataFrame) -> DataFrame:
    """Distinct orders, the greatest row of each; later copies do not spawn children."""
    needed = order_table.select("order_seq", "order_id", "payment_method", "order_status", "amount")
    return dedupe_by_key(needed, ["order_seq"], ["order_id"])


def payments(order_table: DataFrame) -> DataFrame:
    """One payment per distinct order, status depending on the order's."""
    seq = F.col("order_seq")
    return _one_per_order(order_table).withColumn("__drawn", draw("payment-status", seq)).select(
        "order_seq", id_text("payment", seq).alias("payment_id"), "order_id", "payment_method",
        outcome(F.col("order_status"), PAYMENT_OUTCOMES, F.col("__drawn")).alias("payment_status"), "amount",
    )


def shipping(order_table: DataFrame) -> DataFrame:
    """One shipment per distinct order, status depending on the order's."""
    seq = F.col("order_seq")
    return _one_per_order(order_table).withColumn("__drawn", draw("delivery-status", seq)).select(
        "order_seq", id_text("shipment", seq).alias("shipment_id"), "order_id", pick(COURIERS, "courier", seq).alias("courier"),
        outcome(F.col("order_status"), DELIVERY_OUTCOMES, F.col("__drawn")).alias("delivery_status"),
    )


def standalone(spark: SparkSession, customer_count: int, order_count: int, today: dt.date) -> dict[str, DataFrame]:
    """The five clean tables without any input, for demos and fixtures."""
    people = customers(spark.range(1, customer_count + 1), "id", today)
    items = catalog_products(spark)
    seq = F.col("id")
    sold = orders(
        spark.range(order_count), "id",
        padded_id("CUST", draw_below(customer_count, "customer", seq) + 1, 6),
        padded_id("PROD", draw_below(len(PRODUCT_CATALOG), "product", seq) + 1, 4),
        people, items, today,
    )
    return {
        "customers": people, "products": items, "orders": sold, "payments": payments(sold), "shipping": shipping(sold),
    }
