"""Runs the headline queries and prints one JSON line with their seconds.

    BENCH_SF_DIR   folder with the tables (default /root/testdata/sf0.1)
    BENCH_CPUS     local cores (default 8)
    BENCH_RUNS     runs per query, of which the median counts (default 1)
    BENCH_QUERIES  comma-separated names instead of the headline list
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINES = [
    "ing1_route_events", "cur0_curate", "snk3_merge_events", "agg1_window_features", "jn1_joined_features", "fea0_build_features",
    "agg3_daily_event_counts", "agg4_churn_risk_by_cohort", "val0_suite", "prf1_profile", "jn3_asof_latest", "lbl1_merged_labels",
    "drf2_ks_two_sample", "prep4_stratified_split_events", "evl2_roc_auc", "evl3_best_threshold", "scr1_score_linear",
    "jn5_incremental_score", "obs1_high_error_rate", "obs2_latency_percentiles", "obs11_audit_rules",
]


def main() -> None:
    # The bench brings its own folder for intermediate tables and removes it.
    with tempfile.TemporaryDirectory(prefix="ebbtide-") as scratch:
        os.environ["EBBTIDE_SCRATCH"] = scratch
        run()


def run() -> None:
    from ebbtide.plans import catalogue
    from ebbtide.session import local_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINES
    spark = local_session("bench", os.environ.get("BENCH_CPUS", "8"))
    spark.sparkContext.setLogLevel("ERROR")
    # One query first, so that the start of the engine is not booked on whichever comes first.
    catalogue.QUERIES["agg6_spot_check"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        taken = []
        for _ in range(runs):
            began = time.perf_counter()
            catalogue.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - began)
        seconds[name] = round(statistics.median(taken), 3)
    print(json.dumps({
        "metric": "total seconds of the headline queries", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
