"""Recency, frequency, monetary scores and segments per customer."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.functions.columns import whole_cents
from basketry.operators.ntile import add_ntiles
from basketry.plans.metrics import weighted_sales
from basketry.plans.roles import Retail
from basketry.session import stage


def rfm_base(retail: Retail, snapshot: dt.date | None = None, *, fanout: bool = False) -> DataFrame:
    """(customer_id, recency_days, frequency, monetary_cents); undated customers drop out."""
    keys = ["customer_id", "event_date"]
    fact = (weighted_sales(retail, keys) if fanout else retail.sales(keys)).attach(keys)
    today = F.lit(snapshot).cast("date") if snapshot else F.current_date()
    orders = F.count("order_id") if fact.order_unique else F.count_distinct("order_id")
    return (
        fact.df.groupBy("customer_id")
        .agg(
            F.datediff(today, F.max("event_date")).alias("recency_days"),
            orders.alias("frequency"),
            whole_cents(F.sum("exact_amount")).alias("monetary_cents"),
        )
        .where(F.col("recency_days").isNotNull())
    )


def rfm_segments(
    retail: Retail,
    snapshot: dt.date | None = None,
    *,
    fanout: bool = False,
) -> DataFrame:
    """Tertile scores and segment per customer.

    The per-customer table is written once: it is far smaller than the sales
    it comes from and is read several times to place the tile borders.
    """
    base = stage(rfm_base(retail, snapshot, fanout=fanout), "rfm")
    scored = add_ntiles(base, {"R": "recency_days", "F": "frequency", "M": "monetary_cents"}, "customer_id", 3)
    score = F.lit(4) - F.col("R") + F.col("F") + F.col("M")
    segment = (
        F.when(F.col("rfm_score") >= 8, "Champions").when(F.col("rfm_score") >= 6, "Loyal")
        .when(F.col("rfm_score") >= 4, "Potential").otherwise("At Risk")
    )
    return scored.withColumn("rfm_score", score).select(
        "customer_id", "recency_days", "frequency", (F.col("monetary_cents") / 100).alias("monetary"),
        "R", "F", "M", "rfm_score", segment.alias("segment"),
    )


def segment_sizes(segments: DataFrame) -> DataFrame:
    return segments.groupBy("segment").agg(F.count(F.lit(1)).alias("customers"))
