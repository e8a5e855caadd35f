"""The five retail entities in the shape of their contracts, from columns of the star tables.

An order is a row of ``orders`` with its lines rolled up; orders without lines keep null there. Payments and shipments are one row an order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.contracts import COUPON_VERSION_START
from basketry.functions.columns import padded_id
from basketry.plans.roles import read_table

PAID = {"F": "Failed", "O": "Success", "P": "Pending"}
DELIVERED = {"A": "Delivered", "N": "Pending", "R": "Failed"}
TYPES = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")
PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
NATIONS = tuple(f"NATION_{i}" for i in range(25))

# spelling variants, by rule
PRIORITY_SPELLINGS = {v: (v.lower(), v[2:], v.replace("-", " ")) for v in PRIORITIES}
NATION_SPELLINGS = {v: (v.lower(), v.replace("_", " ")) for v in NATIONS}
STATUS_SPELLINGS = {"F": ("f", "Failed"), "O": ("o", "Open"), "P": ("p", "Pending")}
TYPE_SPELLINGS = {v: (v.lower(), v.capitalize(), f" {v}") for v in TYPES}
NATION_REGION = {v: f"REGION_{i % 5}" for i, v in enumerate(NATIONS)}


def _named(code: Column, names: dict[str, str]) -> Column:
    found = F.lit(None).cast("string")
    for key, name in names.items():
        found = F.when(code == key, name).otherwise(found)
    return found


def customers(spark: SparkSession, sf: str) -> DataFrame:
    nations = read_table(spark, sf, "nation").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("city"))
    number = F.substring("c_name", 10, 20)
    return read_table(spark, sf, "customer").join(nations, "c_nationkey", "left").select(
        padded_id("CUST", F.col("c_custkey"), 6).alias("customer_id"), F.col("c_name").alias("name"), (F.col("c_nationkey") + 18).alias("age"),
        F.col("c_mktsegment").alias("gender"), "city", number.alias("phone"),
        F.concat(F.lower("c_mktsegment"), number, F.lit("@example.org")).alias("email"))


def products(spark: SparkSession, sf: str) -> DataFrame:
    return read_table(spark, sf, "part").select(
        padded_id("PROD", F.col("p_partkey"), 4).alias("product_id"), F.col("p_name").alias("product_name"), F.col("p_type").alias("category"),
        F.col("p_brand").alias("brand"), F.col("p_retailprice").alias("price"), F.concat_ws(" ", "p_brand", "p_name", "p_type").alias("description"))


def _lines(spark: SparkSession, sf: str) -> DataFrame:
    """Lines added up per order before they meet the order."""
    return read_table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.min("l_partkey").alias("part"), F.min("l_suppkey").alias("supplier"), F.sum(F.col("l_quantity").cast("bigint")).alias("quantity"),
        F.max("l_extendedprice").alias("price"), F.max(F.rint(F.col("l_discount") * 100).cast("int")).alias("discount"),
        F.min("l_linestatus").alias("line_status"), F.min("l_returnflag").alias("flag"))


def orders(spark: SparkSession, sf: str) -> DataFrame:
    who = customers(spark, sf).select("customer_id", "city")
    heads = read_table(spark, sf, "orders").withColumn("customer_id", padded_id("CUST", F.col("o_custkey"), 6))
    rows = heads.join(_lines(spark, sf), "o_orderkey", "left").join(who, "customer_id", "left")
    regions = F.create_map(*[F.lit(x) for pair in NATION_REGION.items() for x in pair])
    return rows.select(
        F.col("o_orderkey").alias("order_seq"), F.col("o_orderkey").cast("string").alias("order_id"), "customer_id",
        padded_id("PROD", F.col("part"), 4).alias("product_id"), F.col("quantity").cast("int").alias("quantity"), "price", "discount",
        F.col("o_orderpriority").alias("payment_method"), F.col("o_orderstatus").alias("order_status"), "city",
        F.try_element_at(regions, F.col("city")).alias("state"), F.col("o_orderdate").cast("timestamp").alias("event_time"),
        F.col("o_totalprice").alias("amount"), F.when(F.col("o_orderkey") >= COUPON_VERSION_START, F.col("line_status")).alias("coupon_code"))


def payments(spark: SparkSession, sf: str) -> DataFrame:
    key = F.col("o_orderkey").cast("string")
    return read_table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("order_seq"), F.concat(F.lit("PAY"), key).alias("payment_id"), key.alias("order_id"),
        F.col("o_orderpriority").alias("payment_method"), _named(F.col("o_orderstatus"), PAID).alias("payment_status"), F.col("o_totalprice").alias("amount"))


def shipping(spark: SparkSession, sf: str) -> DataFrame:
    key = F.col("o_orderkey").cast("string")
    return read_table(spark, sf, "orders").select("o_orderkey").join(_lines(spark, sf), "o_orderkey", "left").select(
        F.col("o_orderkey").alias("order_seq"), F.concat(F.lit("SHIP"), key).alias("shipment_id"), key.alias("order_id"),
        padded_id("SUPP", F.col("supplier"), 4).alias("courier"), _named(F.col("flag"), DELIVERED).alias("delivery_status"))
