"""The full drift job."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardwarden.operators.drift import (
    drift_summary,
    feature_drift,
    shared_numeric,
    target_drift,
    two_sides,
)
from cardwarden.schema import LABEL
from cardwarden.session import settle
from cardwarden.sources.run_documents import write_run


def drift_report(
    reference: DataFrame,
    current: DataFrame,
    numeric_threshold: float = 0.05,
    target_threshold: float = 0.05,
    label: str = LABEL,
    p_method: str = "asymptotic",
) -> DataFrame:
    """One row per section and subject: every feature, the target (if both sides carry the label)
    and the summary, with the section's values as JSON."""
    columns = shared_numeric(reference, current)
    both = two_sides(reference, current, columns)
    # One row per feature; settled because the summary reads it as well.
    features = settle(feature_drift(both, columns, numeric_threshold, p_method))

    def section(name: str, df: DataFrame, subject) -> DataFrame:
        values = [c for c in df.columns if c != "feature"]
        return df.select(
            F.lit(name).alias("section"), subject.alias("subject"), F.to_json(F.struct(*values)).alias("result")
        )

    report = section("feature", features, F.col("feature")).unionByName(
        section("summary", drift_summary(features), F.lit("all"))
    )
    if label in columns:
        report = report.unionByName(
            section("target", target_drift(both, label, target_threshold), F.lit(label))
        )
    return report


def drift_job(reference: DataFrame, current: DataFrame, path: str, run_id: str, **options) -> None:
    """The report written as a run."""
    write_run(reference.sparkSession, path, run_id, {"report": drift_report(reference, current, **options)})
