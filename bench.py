"""Benchmark the headline queries: prints one JSON line with per-query seconds.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query runs to completion: small results are collected, row-level results are executed through
the ``noop`` sink (no driver transfer). One warm-up query runs first so JVM start-up and code
generation are not charged to the first measured query.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from veritab.plans import catalog  # noqa: E402
from veritab.session import build_session, checkpoint_dir  # noqa: E402

HEADLINE = [
    "d4_feature_drift_orders",
    "d4_feature_drift_events",
    "d8_monthly_drift_history_orders",
    "d8_drift_decisions_orders",
    "a1_quality_report_customer",
    "a2_duplicates_lineitem",
    "a5_distinct_counts_lineitem",
    "a8_describe_lineitem",
    "a9_moments_lineitem",
    "a15_chi2_orders",
    "a16_correlation_lineitem",
    "a19_box_stats_orders",
    "e1_e7_classification_metrics_orders",
    "r3_exact_stratified_split_orders",
    "t6_t9_financial_features_lineitem",
    "t14_standardize_lineitem",
    "p9_p10_quarantine_orders",
    "h1_best_runs_orders",
]
ROW_LEVEL = {"r3_exact_stratified_split_orders", "t6_t9_financial_features_lineitem", "t14_standardize_lineitem", "p9_p10_quarantine_orders"}


def run(spark, name: str, sf_dir: str) -> float:
    t = time.perf_counter()
    df = catalog.QUERIES[name](spark, sf_dir)
    if name in ROW_LEVEL:
        df.write.format("noop").mode("overwrite").save()
    else:
        df.collect()
    return time.perf_counter() - t


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session("veritab-bench", master=f"local[{cpus}]", shuffle_partitions=4 * cpus, driver_memory="16g")
    checkpoint_dir(spark, fallback="/tmp/veritab-bench-ckpt")
    run(spark, "a7_majority_share_orders", sf_dir)  # warm-up
    times = {n: round(run(spark, n, sf_dir), 3) for n in HEADLINE}
    sf = sf_dir.rsplit("sf", 1)[-1]
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
