"""The promotion job over metric and registry tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardwarden.operators.promotion import (
    MIN_PRECISION_RATIO,
    apply_promotions,
    champion_metrics,
    champion_versions,
    promotion_gate,
    promotion_metrics,
)
from cardwarden.session import settle
from cardwarden.sources.run_documents import write_run


def with_metric_maps(report: DataFrame, metrics: DataFrame) -> DataFrame:
    """The report with all metrics of both runs, by name; a run without metrics has none."""
    maps = metrics.groupBy("run_id").agg(F.map_from_entries(F.collect_list(F.struct("name", "value"))).alias("values"))
    for side in ("challenger", "champion"):
        own = maps.select(F.col("run_id").alias(f"{side}_run_id"), F.col("values").alias(f"{side}_metrics"))
        report = report.join(own, f"{side}_run_id", "left")
    return report


def promotion_job(
    challengers: DataFrame, metrics: DataFrame, registry: DataFrame, path: str, run_id: str,
    min_precision_ratio: float = MIN_PRECISION_RATIO,
) -> None:
    """Gate the challengers and write the report, with both runs' metrics, and the new registry as a run."""
    metrics, registry = settle(metrics), settle(registry)
    report, after = promote(challengers, metrics, registry, min_precision_ratio)
    write_run(challengers.sparkSession, path, run_id, {"report": with_metric_maps(report, metrics)}, {"registry": after})


def promote(
    challengers: DataFrame,
    metrics: DataFrame,
    registry: DataFrame,
    min_precision_ratio: float = MIN_PRECISION_RATIO,
) -> tuple[DataFrame, DataFrame]:
    """Gate challenger runs ``(model_name, run_id)`` against the champions.

    Returns the report, one row per model, and the registry after all promotions.
    """
    measured = challengers.join(promotion_metrics(metrics), "run_id", "left")
    champions = champion_metrics(registry, metrics)
    gate = promotion_gate(measured, champions, min_precision_ratio)
    report = (
        challengers.withColumnRenamed("run_id", "challenger_run_id")
        .join(gate, "model_name")
        .join(
            champion_versions(registry).select(
                "model_name", F.col("run_id").alias("champion_run_id"), F.col("version").alias("champion_version")
            ),
            "model_name",
            "left",
        )
    )
    promoted = report.where("promoted").select("model_name", F.col("challenger_run_id").alias("run_id"))
    return report, apply_promotions(registry, promoted)
