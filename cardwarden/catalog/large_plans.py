"""Registered queries run by the plans meant for large tables.

Buckets of a few rows in two levels, nothing broadcast by size, hot keys from a few rows on, digests narrowed to
the end: the same rows as by default have to come out, so each query keeps its SQL counterpart.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cardwarden.catalog import feature_queries, ingest, quality_queries  # noqa: F401
from cardwarden.catalog.base import ORACLES, QUERIES, query

LARGE_PLANS = {
    "cardwarden.rowsPerBucket": "400",
    "cardwarden.bucketsPerLevel": "16",
    "cardwarden.broadcastBytes": "0",
    "cardwarden.rowsPerTask": "50",
    "cardwarden.digestRange": "0",
}

NAMES = [
    "feature_drift",
    "split_shift",
    "ks_statistic",
    "serving_defaults",
    "latency_p95",
    "split_metrics",
    "pr_curve",
    "roc_curve",
    "roc_corners",
    "psi",
    "all_features",
    "pit_customer_stats",
    "stratified_split_exact",
]


def _with_large_plans(name: str) -> None:
    plain = QUERIES[name]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        # Plans are chosen while the query is built, so the settings are needed no longer than that.
        before = {k: spark.conf.get(k, None) for k in LARGE_PLANS}
        for k, v in LARGE_PLANS.items():
            spark.conf.set(k, v)
        try:
            return plain(spark, sf_dir)
        finally:
            for k, v in before.items():
                spark.conf.unset(k) if v is None else spark.conf.set(k, v)

    query(f"{name}_large_plan", ORACLES[name])(run)


for _name in NAMES:
    _with_large_plans(_name)
