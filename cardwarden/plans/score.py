"""The batch scoring job: requests, rules, rejects, scores, totals."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from cardwarden.operators.scoring import score_requests
from cardwarden.operators.validation import Rule, request_rules, with_reasons
from cardwarden.schema import REQUEST_SCHEMA
from cardwarden.session import settle_table
from cardwarden.sources.run_documents import write_run


def complete_requests(requests: DataFrame) -> DataFrame:
    """All request columns with their types; those that the requests lack are missing in every row, so that the rules
    reject the rows instead of the job failing on them."""
    absent = {f.name: F.lit(None).cast(f.dataType) for f in REQUEST_SCHEMA.fields if f.name not in requests.columns}
    return requests.withColumns(absent)


def score_job(
    requests: DataFrame, model: PipelineModel, defaults: dict[str, float], path: str, run_id: str, threshold: float = 0.5,
    keep: list[str] | None = None, rules: list[Rule] | None = None,
) -> DataFrame:
    """Score the valid requests, set the others aside with their reasons, and write both with the totals as a run.

    The requests are read once, while their checked rows are written; the totals are counted by the writes. Returns the
    totals, one row: ``requests, rejected, scored, flagged, flagged_rate``.
    """
    spark: SparkSession = requests.sparkSession
    seen, decided = Observation(), Observation()
    checked = with_reasons(complete_requests(requests), rules or request_rules())
    checked = checked.observe(seen, F.count(F.lit(1)).alias("requests"), F.count_if(~F.col("valid")).alias("rejected"))
    checked = settle_table(checked, "checked-requests")
    scored = score_requests(checked.where("valid").drop("valid", "reasons"), model, defaults, threshold, keep)
    scored = scored.observe(decided, F.count(F.lit(1)).alias("scored"), F.count_if("is_fraud").alias("flagged"))
    scored = settle_table(scored, "scored-requests")
    numbers = (seen.get["requests"], seen.get["rejected"], decided.get["scored"], decided.get["flagged"])
    rate = numbers[3] / max(numbers[2], 1)
    totals = spark.createDataFrame(
        [(*numbers, rate)], "requests bigint, rejected bigint, scored bigint, flagged bigint, flagged_rate double"
    )
    write_run(spark, path, run_id, {"totals": totals}, {"scored": scored, "rejected": checked.where("NOT valid").drop("valid")})
    return totals
