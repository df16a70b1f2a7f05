"""Row features: time of day, distance and amount anomalies, and the full feature chain."""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardwarden.functions.geo import great_circle_km
from cardwarden.operators.group_stats import join_all_statistics
from cardwarden.schema import LABEL, TIMESTAMP_FORMAT, numeric_features

# Fixed values of the feature definitions.
WEEKEND_STARTS = 5  # Monday is 0
DISTANT_KM = 100.0
OUTLIER_SCORE = 3.0
RATIO_CAP = 100.0


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it fails or cannot be decided."""
    return F.coalesce(condition, F.lit(False)).cast("int")


def add_temporal_features(df: DataFrame) -> DataFrame:
    ts = F.to_timestamp("trans_date_trans_time", TIMESTAMP_FORMAT)
    return df.withColumns(
        {
            "hour_of_day": F.hour(ts),
            "day_of_week": F.weekday(ts),
            "is_weekend": flag(F.weekday(ts) >= WEEKEND_STARTS),
            "month": F.month(ts),
            "day_of_month": F.dayofmonth(ts),
        }
    )


def add_distance_features(df: DataFrame) -> DataFrame:
    km = great_circle_km("lat", "long", "merch_lat", "merch_long")
    return df.withColumn("distance_km", km).withColumn(
        "is_distant_txn", flag(F.col("distance_km") > DISTANT_KM)
    )


def add_amount_features(df: DataFrame) -> DataFrame:
    """Needs the card statistics; a missing statistic gives z-score 0 and a missing ratio."""
    z = (F.col("amt") - F.col("customer_avg_amt")) / (F.col("customer_std_amt") + 1.0)
    ratio = F.try_divide(F.col("amt"), F.col("customer_avg_amt") + 1.0)
    return df.withColumn("amt_zscore", F.coalesce(z, F.lit(0.0))).withColumns(
        {
            "amt_is_outlier": flag(F.abs("amt_zscore") > OUTLIER_SCORE),
            "amt_ratio_to_customer_avg": F.when(ratio > RATIO_CAP, F.lit(RATIO_CAP)).otherwise(ratio),
        }
    )


def add_all_features(
    df: DataFrame, spread_by: list[str] | None = None, **limits: int
) -> DataFrame:
    """All derived columns in catalogue order.

    Group statistics cover all rows of ``df`` including the row itself; for leak-free variants see
    the point-in-time statistics and the fitted statistics.
    """
    return (
        df.transform(add_temporal_features)
        .transform(lambda d: join_all_statistics(d, spread_by=spread_by, **limits))
        .transform(add_distance_features)
        .transform(add_amount_features)
    )


def feature_matrix(df: DataFrame, label: str = LABEL) -> DataFrame:
    """Numeric predictors plus the label as an integer."""
    return df.select(*numeric_features(df, label), F.col(label).cast("int").alias(label))


def assembler(features: list[str], output: str = "raw_features") -> VectorAssembler:
    """A vector column over the named predictors; a missing value fails the job."""
    return VectorAssembler(inputCols=features, outputCol=output, handleInvalid="error")
