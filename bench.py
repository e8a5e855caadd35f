"""Headline query times: one JSON line on stdout.

BENCH_SF_DIR  table folder (default /root/testdata/sf0.1)
BENCH_CPUS    cores (default 8)
BENCH_RUNS    timed runs after one warm-up, the median counts (default 3)
"""

from __future__ import annotations

import json
import os
import statistics
import time

from basketry.catalog import REGISTRY
from basketry.session import build_session

HEADLINE = (
    # metrics
    "daily_revenue", "revenue_by_category", "revenue_by_city", "sales_by_category", "revenue_per_product",
    "customer_lifetime_value", "repeat_customers", "top10_customers", "new_vs_returning", "rfm_scores",
    "rfm_scores_by_cuts", "gold_row_counts", "dash_daily_revenue", "sales_fanout_report", "entity_daily_revenue",
    "payment_success_rate", "delivery_performance", "avg_delivery_time", "daily_revenue_fanout",
    # tables
    "sales_fact", "dedupe_by_key", "dedupe_rows", "silver_clean", "decode_typed", "decode_inferred", "jsonl_encode",
    # quality and faults
    "dq_duplicates", "dq_nulls", "dq_referential", "canonicalize", "fault_all",
    # streams
    "ingest_envelope", "bronze_append",
)


def timed(spark, name: str, folder: str) -> float:
    """Seconds to build the plan, run it and throw the rows away."""
    start = time.perf_counter()
    REGISTRY[name].run(spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(
        "bench", cpus, spark__sql__shuffle__partitions=cpus, spark__driver__memory="12g",
        spark__python__sql__dataFrameDebugging__enabled="false",
    )
    seconds = {}
    for name in HEADLINE:
        timed(spark, name, folder)
        seconds[name] = round(statistics.median(timed(spark, name, folder) for _ in range(runs)), 3)
    spark.stop()
    print(json.dumps({
        "metric": "headline queries, median of warm runs, summed", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"), "cpus": int(cpus),
    }))


if __name__ == "__main__":
    main()
