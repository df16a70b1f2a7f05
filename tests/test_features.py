import math

import pytest
from pyspark.sql import functions as F

from cardwarden.operators.features import (
    add_all_features,
    add_amount_features,
    add_distance_features,
    add_temporal_features,
    feature_matrix,
)
from cardwarden.operators.group_stats import (
    CARD,
    GROUPINGS,
    group_statistics,
    join_all_statistics,
    join_statistics,
)
from cardwarden.operators.scoring import request_features
from cardwarden.schema import ENGINEERED, FEATURE_GROUPS, GROUP_STATS, numeric_features
from cardwarden.sources.events import transactions

EXPECTED = [
    {
        "hour_of_day": 0, "day_of_week": 1, "is_weekend": 0, "month": 1, "day_of_month": 1,
        "customer_txn_count": 2, "customer_avg_amt": 505.0, "customer_std_amt": 700.0357133747,
        "customer_fraud_rate": 0.5, "merchant_fraud_rate": 0.0, "merchant_txn_count": 1,
        "merchant_avg_amt": 1000.0, "merchant_std_amt": 0.0, "category_fraud_rate": 0.0,
        "category_txn_count": 1, "category_avg_amt": 1000.0, "distance_km": 5.516605728339,
        "is_distant_txn": 0, "amt_zscore": 0.70609812, "amt_is_outlier": 0,
        "amt_ratio_to_customer_avg": 1.97628458,
    },
    {
        "hour_of_day": 1, "merchant_fraud_rate": 1.0, "merchant_avg_amt": 10.0, "category_fraud_rate": 1.0,
        "category_avg_amt": 10.0, "distance_km": 6.974925230690, "amt_zscore": -0.70609812,
        "amt_ratio_to_customer_avg": 0.01976285,
    },
]


def test_two_row_fixture(two_rows):
    out = add_all_features(two_rows).orderBy("trans_date_trans_time").collect()
    assert len(out) == 2
    for row, want in zip(out, EXPECTED):
        for name, value in want.items():
            assert row[name] == pytest.approx(value, abs=1e-8), name


def test_catalogue_order_and_matrix_width(spark, sf_dir):
    txn = transactions(spark, sf_dir)
    features = add_all_features(txn, spread_by=["row_id"])
    assert features.columns == txn.columns + ENGINEERED
    assert len(ENGINEERED) == 21
    assert len(numeric_features(features)) == 28
    matrix = feature_matrix(features)
    assert "row_id" not in matrix.columns and dict(matrix.dtypes)["is_fraud"] == "int"


def test_missing_keys_keep_missing_statistics(spark, two_rows):
    df = two_rows.withColumn("cc_num", F.when(F.col("merchant") == "M2", F.col("cc_num")))
    for limit in (1 << 30, 0):
        out = join_statistics(df, CARD, broadcast_bytes=limit).orderBy("merchant").collect()
        assert out[0]["customer_txn_count"] is None
        assert out[1]["customer_txn_count"] == 1
    amounts = add_amount_features(join_statistics(df, CARD)).orderBy("merchant").collect()
    assert amounts[0]["amt_zscore"] == 0.0
    assert amounts[0]["amt_is_outlier"] == 0
    assert amounts[0]["amt_ratio_to_customer_avg"] is None


def test_shuffled_join_equals_broadcast_join_with_hot_and_missing_keys(spark):
    hot = spark.range(300).select(
        F.col("id").alias("row_id"),
        F.when(F.col("id") % 3 == 0, F.lit("hot"))
        .when(F.col("id") % 3 == 1, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("k"), F.col("id").cast("string")))
        .alias("cc_num"),
        F.col("id").cast("double").alias("amt"),
        (F.col("id") % 7 == 0).cast("int").alias("is_fraud"),
    )
    wanted = sorted(map(str, join_statistics(hot, CARD, spread_by=["row_id"]).collect()))
    for rows_per_task in (1, 7, 10_000):
        got = join_statistics(
            hot, CARD, spread_by=["row_id"], broadcast_bytes=0, rows_per_task=rows_per_task
        )
        assert sorted(map(str, got.collect())) == wanted


def test_one_scan_statistics_equal_single_groupings(spark, sf_dir):
    txn = transactions(spark, sf_dir).select(
        "row_id", "cc_num", "merchant", "category", "amt", "is_fraud"
    )
    wanted = txn
    for g in GROUPINGS:
        wanted = wanted.join(group_statistics(txn, g), g.key, "left")
    wanted = wanted.select(*txn.columns, *GROUP_STATS).orderBy("row_id").collect()
    for limit in (1 << 30, 0):
        got = join_all_statistics(txn, spread_by=["row_id"], broadcast_bytes=limit, rows_per_task=50)
        for a, b in zip(got.orderBy("row_id").collect(), wanted):
            assert a.asDict() == pytest.approx(b.asDict(), abs=1e-9)


def test_week_starts_on_monday(spark):
    df = spark.createDataFrame(
        [("2024-01-01 05:00:00",), ("2024-01-06 23:59:59",), ("2024-01-07 00:00:00",)],
        "trans_date_trans_time string",
    )
    rows = add_temporal_features(df).collect()
    assert [r["day_of_week"] for r in rows] == [0, 5, 6]
    assert [r["is_weekend"] for r in rows] == [0, 1, 1]


def test_distance_edge_cases(spark):
    df = spark.createDataFrame(
        [(0.0, 0.0, 0.0, 180.0), (10.0, 20.0, 10.0, 20.0), (None, 0.0, 0.0, 0.0)],
        "lat double, long double, merch_lat double, merch_long double",
    )
    far, same, missing = add_distance_features(df).collect()
    assert far["distance_km"] == pytest.approx(3.141592653589793 * 3959 * 1.60934)
    assert far["is_distant_txn"] == 1
    assert same["distance_km"] == 0.0 and same["is_distant_txn"] == 0
    assert missing["distance_km"] is None and missing["is_distant_txn"] == 0


def test_ratio_is_capped_and_outlier_is_strict(spark):
    df = spark.createDataFrame(
        [(1000.0, 1.0, 0.0), (4.0, 1.0, 0.0), (5.0, 1.0, 0.0)],
        "amt double, customer_avg_amt double, customer_std_amt double",
    )
    rows = add_amount_features(df).collect()
    assert rows[0]["amt_ratio_to_customer_avg"] == 100.0
    assert [r["amt_is_outlier"] for r in rows] == [1, 0, 1]


def test_request_sample(spark):
    sample = spark.createDataFrame(
        [("4263981246278992", 2.86, 33.9659, -80.9355, 1325376018, 33.986391, -81.200714)],
        "cc_num string, amt double, lat double, long double, unix_time long, merch_lat double, merch_long double",
    )
    row = request_features(sample, dict.fromkeys(GROUP_STATS, 1.0)).first()
    # Independent of the expression under test; the fixture sheet's 24.562914967334 is off by 4e-7.
    lat1, lon1, lat2, lon2 = map(math.radians, (33.9659, -80.9355, 33.986391, -81.200714))
    a = math.sin((lat2 - lat1) / 2) ** 2 + math.cos(lat1) * math.cos(lat2) * math.sin((lon2 - lon1) / 2) ** 2
    km = 2 * math.atan2(math.sqrt(a), math.sqrt(1 - a)) * 3959 * 1.60934
    assert row["distance_km"] == pytest.approx(km, abs=1e-9)
    assert km == pytest.approx(24.562914967334, abs=1e-6)
    assert (row["hour_of_day"], row["day_of_week"], row["is_weekend"]) == (0, 6, 1)
    assert set(FEATURE_GROUPS["amount"]) <= set(row.asDict())
