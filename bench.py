"""Benchmark the headline queries; print one JSON line.

    BENCH_SF_DIR   driver tables (default /root/testdata/sf0.1)
    BENCH_CPUS     local[N] (default 8)
    BENCH_REPEAT   timed runs per query after one warm-up (default 3)
    BENCH_QUERIES  comma list to run instead of the headline set
    BENCH_SHUFFLE_PARTITIONS  spark.sql.shuffle.partitions (default: BENCH_CPUS)
    BENCH_ALL=1    every registered query, one timed run each

Each run builds the query, executes it completely and transfers the whole
result to the driver as Arrow batches (``toArrow``; plain ``collect`` spends
most of its time building Python Row objects for large results, and Spark's
``noop`` sink added a fixed ~2 s per run on this machine). The time covers
planning, every stage and the result transfer.
The reported value is the sum of the per-query warm medians.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = (
    # the reference's four timed queries first
    "monthly_revenue", "rfm_segments", "v_product_performance", "campaign_roi",
    "daily_sales_running", "best_sellers", "category_performance", "customer_clv",
    "vip_customers", "channel_effectiveness", "attribution", "shipping_performance",
    "cohort_retention", "market_basket", "product_affinity", "churn_risk", "v_sales_summary",
    "mv_category_performance", "recommend_products", "inventory_ledger", "business_metrics",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    run_all = os.environ.get("BENCH_ALL") == "1"

    from tillroll import registry
    from tillroll.session import local_session

    parts = int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", str(cpus)))
    spark = local_session(cpus, shuffle_partitions=parts, app="tillroll-bench")
    registry.load_all()
    names = (sorted(registry.QUERIES) if run_all else
             [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n])
    if run_all:
        repeat = 1

    def once(name: str) -> float:
        t0 = time.perf_counter()
        registry.runner(name)(spark, sf_dir).toArrow()
        return time.perf_counter() - t0

    results = {}
    for name in names:
        once(name)  # warm-up: JIT, file listing, Python imports
        results[name] = round(statistics.median(once(name) for _ in range(repeat)), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "sum_of_warm_median_query_seconds", "value": round(sum(results.values()), 3),
                      "unit": "sec", "queries": results, "sf": sf, "cpus": cpus, "repeat": repeat}))
    spark.stop()


if __name__ == "__main__":
    main()
