"""Headline queries, timed. Prints one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from cardwarden.catalog import QUERIES  # noqa: E402
from cardwarden.session import build_session  # noqa: E402

HEADLINE = [
    "validate_rules",
    "dataset_summary",
    "customer_stats",
    "join_customer_stats",
    "all_features",
    "prepared_dataset",
    "stratified_split_exact",
    "stratified_sample",
    "serving_defaults",
    "score_features",
    "split_metrics",
    "pr_curve",
    "classification_report",
    "feature_drift",
    "split_shift",
    "target_drift",
    "psi",
    "pit_customer_stats",
    "promotion_gate",
    "logistic_fit",
    "gbt_fit",
    "score_batch",
    "stream_outcome_counts",
    "stream_customer_state",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", int(cpus))
    spark.sparkContext.setLogLevel("ERROR")
    # Start the JVM's and Python's worker pools outside the measurement.
    QUERIES["customer_stats"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in sys.argv[1:] or HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    total = round(sum(seconds.values()), 3)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": total,
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
