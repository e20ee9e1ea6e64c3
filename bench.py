"""Time the headline queries: one warm-up run each, then the median of BENCH_RUNS (1). Prints one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from tidemill.plans.catalogue import QUERIES
from tidemill.session import local_session

HEADLINE = (
    "stg_orders", "stg_order_items", "stg_user_events", "stg_events", "stg_transactions",
    "mart_daily_sales", "mart_daily_sales_dag", "mart_daily_funnel", "mart_payment_funnel", "mart_revenue",
    "mart_user_retention", "dau_cohort", "session_analysis", "trending_searches", "purchase_funnel",
    "funnel_transitions", "product_performance", "category_sales_weekly", "stock_alerts",
    "payment_funnel_dropoff", "retention_pivot", "revenue_analysis", "active_users", "arppu_daily",
    "domain_rates", "metric_base_sets", "parse_events", "session_window_agg", "validate_event_schema",
    "cdc_to_row", "dq_run_all", "dq_suite_run",
)


def run_once(spark, key: str, sf_dir: str) -> float:
    started = time.perf_counter()
    QUERIES[key].spark(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    keys = sys.argv[1:] or HEADLINE
    spark = local_session("tidemill-bench", cores=cores, shuffle_partitions=cores)
    times = {}
    for key in keys:
        run_once(spark, key, sf_dir)
        times[key] = round(statistics.median(run_once(spark, key, sf_dir) for _ in range(runs)), 3)
    result = {
        "metric": "total_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
        "cpus": cores,
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
