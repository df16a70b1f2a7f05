"""Batch scoring: request rows to features to decisions."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardwarden.operators.features import add_amount_features, add_distance_features, add_temporal_features
from cardwarden.schema import GROUP_STATS, TIMESTAMP_FORMAT, numeric_features


def collect_defaults(defaults: DataFrame) -> dict[str, float]:
    """The eleven training medians as plain numbers."""
    return {r["feature"]: float(r["value"]) for r in defaults.collect()}


def request_features(requests: DataFrame, defaults: dict[str, float]) -> DataFrame:
    """All model features of unlabelled requests.

    A missing time string is derived from the epoch seconds in UTC. Group statistics are the
    training medians for every row, known cards included, exactly as the online scorer does it.
    Nothing here groups or joins, so the same code serves batches and streams.
    """
    df = requests
    if "trans_date_trans_time" not in df.columns:
        stamp = F.date_format(F.timestamp_seconds("unix_time"), TIMESTAMP_FORMAT)
        df = df.withColumn("trans_date_trans_time", stamp)
    return (
        df.transform(add_temporal_features)
        .withColumns({c: F.lit(float(defaults[c])) for c in GROUP_STATS})
        .transform(add_distance_features)
        .transform(add_amount_features)
    )


def decide(df: DataFrame, score: str | Column, threshold: float = 0.5) -> DataFrame:
    """Append the response: rounded probability, decision on the unrounded one, threshold."""
    p = F.col(score) if isinstance(score, str) else score
    return df.withColumns(
        {
            "fraud_probability": F.round(p, 6),
            "is_fraud": p >= F.lit(threshold),
            "threshold": F.lit(float(threshold)),
        }
    )


def positive_probability(column: str = "probability") -> Column:
    return vector_to_array(F.col(column))[1]


def score_requests(
    requests: DataFrame,
    model: PipelineModel,
    defaults: dict[str, float],
    threshold: float = 0.5,
    keep: list[str] | None = None,
) -> DataFrame:
    """``keep`` columns plus the response for every request row; set-based, no row loop."""
    features = request_features(requests, defaults)
    scored = model.transform(features).withColumn("_p", positive_probability())
    decided = decide(scored, "_p", threshold)
    return decided.select(*(keep or ["trans_num"]), "fraud_probability", "is_fraud", "threshold")


def model_features(df: DataFrame) -> list[str]:
    return numeric_features(df)
