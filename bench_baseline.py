"""The plain formulation of the metrics against this engine, on the same data.

Plain: entity tables hold one JSON text per row, every metric decodes all five,
joins them left to left with whatever fan-out the keys give, and aggregates.
Engine: the tables are decoded once into typed columns, and a metric reads only
the columns and joins it needs; the fan-out is a weight.

Prints one JSON line. BENCH_SF_DIR, BENCH_CPUS and BENCH_RUNS as in bench.py.
"""

from __future__ import annotations

import datetime as dt
import json
import os
import statistics
import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from basketry.functions.columns import to_event_date
from basketry.operators.decode import decode_inferred, decode_typed, infer_schema
from basketry.plans.metrics import metric
from basketry.plans.rfm import rfm_segments
from basketry.plans.roles import EntityRetail, StarRetail
from basketry.session import build_session, stage
from basketry.sources.files import json_text

SNAPSHOT = dt.date(2001, 8, 2)


def entity_tables(spark, folder: str) -> dict[str, DataFrame]:
    """The star tables in entity form."""
    retail = StarRetail(spark, folder)
    text = lambda c: F.col(c).cast("string").alias(c)
    sold = retail.lines.attach(["customer_id", "event_time", "city", "state"]).df
    status = F.col("delivery_status")
    ships = retail.shipping.attach(["courier"]).df
    return {
        "orders": sold.select(
            text("order_id"), text("customer_id"), text("product_id"), F.col("quantity").cast("double").alias("quantity"), F.col("exact_amount").cast("double").alias("amount"),
            "city", "state", F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss").alias("event_time"),
        ),
        "customers": retail.customers.select(text("customer_id"), "name", "gender", "city"),
        "products": retail.products.select(text("product_id"), "product_name", "category", "brand", "price"),
        "payments": retail.payments.df.select(
            text("payment_id"), text("order_id"), "payment_method", "payment_status", F.col("exact_amount").cast("double").alias("amount"),
        ),
        "shipping": ships.select(text("order_id"), "courier", status, "message_date"),
    }


def as_messages(spark, tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Stored envelope rows: opaque JSON plus the message time."""
    out = {}
    for name, df in tables.items():
        at = F.col("message_date") if name == "shipping" else F.lit("2001-08-02")
        fields = [F.col(c) for c in df.columns if c != "message_date"]
        out[name] = stage(df.select(json_text(*fields).alias("value"), at.cast("timestamp").alias("timestamp")), name)
    return out


def plain_sales(t: dict[str, DataFrame]) -> DataFrame:
    who = t["customers"].select("customer_id", "name", "gender", F.col("city").alias("customer_city"))
    what = t["products"].select("product_id", "product_name", "category", "brand")
    return (
        t["orders"].join(who, "customer_id", "left").join(what, "product_id", "left")
        .join(t["payments"].select("order_id", "payment_id", "payment_status"), "order_id", "left")
        .join(t["shipping"].select("order_id", "courier", "delivery_status"), "order_id", "left")
        .withColumn("day", F.try_to_date("event_time"))
    )


def plain_rfm(s: DataFrame) -> DataFrame:
    base = s.groupBy("customer_id").agg(
        F.datediff(F.lit(SNAPSHOT), F.max("day")).alias("r"), F.count_distinct("order_id").alias("f"), F.sum("amount").alias("m")
    )
    return base.withColumns({c.upper(): F.ntile(3).over(Window.orderBy(c)) for c in "rfm"})


PLAIN = {
    "daily_revenue": lambda s: s.groupBy("day").agg(F.sum("amount"), F.count(F.lit(1))),
    "revenue_by_city": lambda s: s.groupBy("city").agg(F.sum("amount"), F.count_distinct("order_id")),
    "revenue_by_category": lambda s: s.groupBy("category").agg(F.sum("amount"), F.count_distinct("order_id")),
    "sales_by_category": lambda s: s.groupBy("category").agg(
        F.sum("amount"), F.sum("quantity"), F.count_distinct("order_id"), F.count_distinct("product_id")),
    "revenue_per_product": lambda s: s.groupBy("product_id", "product_name", "category", "brand").agg(
        F.sum("amount"), F.sum("quantity"), F.count_distinct("order_id"), F.round(F.avg("amount"), 2)),
    "customer_lifetime_value": lambda s: s.groupBy("customer_id").agg(F.sum("amount"), F.count_distinct("order_id")),
    "top_customers": lambda s: s.groupBy("customer_id", "name", "gender", "customer_city").agg(
        F.sum("amount"), F.count_distinct("order_id"), F.round(F.avg("amount"), 2)),
    "rfm": plain_rfm,
}


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus, runs = os.environ.get("BENCH_CPUS", "8"), int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session("baseline", cpus, spark__sql__shuffle__partitions=cpus, spark__driver__memory="12g")

    def timed(build) -> float:
        def once() -> float:
            start = time.perf_counter()
            build().write.format("noop").mode("overwrite").save()
            return time.perf_counter() - start

        once()
        return round(statistics.median(once() for _ in range(runs)), 3)

    messages = as_messages(spark, entity_tables(spark, folder))
    schemas = {name: infer_schema(df) for name, df in messages.items()}
    decode = lambda: {n: decode_typed(df, schemas[n], {"timestamp": "kafka_timestamp"}) for n, df in messages.items()}

    start = time.perf_counter()
    typed = {n: decode_inferred(df) for n, df in messages.items()}
    typed["orders"] = typed["orders"].withColumn("event_date", to_event_date(typed["orders"]))
    typed = {n: stage(df, f"typed-{n}") for n, df in typed.items()}
    typed_seconds = round(time.perf_counter() - start, 3)

    def engine(name: str) -> DataFrame:
        retail = EntityRetail(typed, unique=False)
        if name == "rfm":
            return rfm_segments(retail, SNAPSHOT, fanout=True)
        return metric(name, retail, fanout=True)

    result = {name: {"plain": timed(lambda: build(plain_sales(decode()))), "engine": timed(lambda: engine(name))} for name, build in PLAIN.items()}
    spark.stop()
    print(json.dumps({"decode_once": typed_seconds, "queries": result, "sf": os.path.basename(folder), "cpus": int(cpus)}))


if __name__ == "__main__":
    main()
