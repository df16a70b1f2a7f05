"""The physical plans are the ones the operators promise."""

import re

import pytest
from pyspark.sql import functions as F

from cardwarden.catalog import ORACLES, QUERIES
from cardwarden.catalog.base import scored
from cardwarden.operators.group_stats import CARD, group_statistics, join_statistics
from cardwarden.operators.metrics import ranking_metrics
from cardwarden.sources.events import transactions

BATCH = [
    "all_features", "temporal_features", "distance_features", "feature_matrix", "customer_stats", "validate_rules",
    "split_metrics", "roc_curve", "stratified_split_exact", "pit_customer_stats", "promotion_gate", "ks_statistic",
    "serving_defaults", "score_features", "classification_report", "dataset_summary",
]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", BATCH)
def test_no_python_rows_no_cross_joins_no_whole_table_windows(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    assert "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text
    assert "BatchEvalPython" not in text and "ArrowEvalPython" not in text
    assert not re.search(r"Window \[.*\](, )?\[\], \[", text)


def test_wide_rows_are_not_shuffled_for_small_statistics(spark, sf_dir):
    text = plan(join_statistics(transactions(spark, sf_dir), CARD, spread_by=["row_id"]))
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text
    assert "Exchange hashpartitioning" not in text


def test_large_statistics_are_not_broadcast(spark, sf_dir):
    txn = transactions(spark, sf_dir)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(join_statistics(txn, CARD, spread_by=["row_id"], broadcast_bytes=0))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # Only the bounded list of hot keys is broadcast.
    assert text.count("BroadcastHashJoin") == 1 and "SortMergeJoin" in text


def test_statistics_combine_before_the_shuffle_and_read_few_columns(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    slim = events.select(F.col("user_id").cast("string").alias("cc_num"), F.col("value").alias("amt"), F.lit(0).alias("is_fraud"))
    text = plan(group_statistics(slim, CARD))
    assert "partial_avg" in text
    assert "props" not in text


def test_ties_collapse_before_the_shuffle(spark, sf_dir):
    text = plan(ranking_metrics(scored(spark, sf_dir), ["model", "split"], buckets=4))
    assert "partial_sum" in text and "partial_count" in text


def test_every_oracle_belongs_to_a_query():
    assert set(ORACLES) <= set(QUERIES)
    assert len(QUERIES) >= 90
