"""Wall time of the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default: all cores), BENCH_RUNS (default 2,
the median counts, after one warm-up run) and BENCH_QUERIES (comma list, or `all`) set the run.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from checks import registry
from shelfmark.session import local_session

HEADLINE = (
    "revenue_by_category", "line_facts", "return_rate", "running_revenue_by_region", "product_rank_in_category",
    "customer_risk", "monthly_customer_buckets", "ltv_quartiles", "yoy_growth", "category_shift",
    "pareto_customers", "basket_pairs", "cohort_retention", "customers_never_delivered", "period_comparison",
    "period_breakdown_weekly", "region_performance", "customer_totals", "clean_orders", "clean_order_items",
    "quarantine_order_items", "mask_customers", "mart_sales_summary", "mart_customer_summary", "upsert",
    "dedupe_by_key",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = int(os.environ.get("BENCH_CPUS") or os.cpu_count() or 1)
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    wanted = os.environ.get("BENCH_QUERIES", "")
    jobs = registry.queries()
    names = list(jobs) if wanted == "all" else [n for n in wanted.split(",") if n] or list(HEADLINE)

    spark = local_session(cores, shuffle_partitions=cores)
    spark.sparkContext.setLogLevel("ERROR")

    def timed(name: str) -> float:
        started = time.perf_counter()
        jobs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - started

    seconds = {}
    for name in names:
        timed(name)
        seconds[name] = round(statistics.median(timed(name) for _ in range(runs)), 3)
    print(json.dumps({
        "metric": "headline query wall time", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")), "cpus": cores, "runs": runs,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
