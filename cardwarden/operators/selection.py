"""Best model, most shifted features, importances."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def best_model(metrics: DataFrame, by: list[str] | None = None, metric: str = "auprc") -> DataFrame:
    """The model with the highest metric; among equals the lowest ``position`` wins.

    ``metrics`` has ``model, position`` and the metric column; the tie rule is data, so the caller
    chooses it (first trained, or trees before linear).
    """
    order = F.struct(F.col(metric), -F.col("position"))
    return metrics.groupBy(*(by or [])).agg(
        F.max_by("model", order).alias("best_model"), F.max(metric).alias(f"best_{metric}")
    )


def top_features(drift: DataFrame, n: int = 5, statistic: str = "ks") -> DataFrame:
    """The ``n`` largest statistics; equal ones in name order."""
    return drift.orderBy(F.desc(statistic), "feature").limit(n)
