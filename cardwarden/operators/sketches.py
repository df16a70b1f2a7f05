"""Data-set summaries that add up: one row of totals and distinct-count sketches per day and source.

An exact distinct count has to see all rows again whenever days are added. Here each day is summarised once and
stored; any choice of days and sources is united from those few rows. The sketches are HyperLogLog sketches of a
fixed size (``2 ** PRECISION`` registers at most), so a day costs some kilobytes whatever its number of keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardwarden.schema import LABEL, TIMESTAMP_FORMAT

#: Registers as a power of two; the standard error of a united count is about 1.04 / 2 ** (PRECISION / 2), 0.8 %.
PRECISION = 14
#: Columns whose distinct values are counted, and the names of the counts.
KEYS = {"cc_num": "unique_cards", "merchant": "unique_merchants", "category": "unique_categories"}


def daily_summaries(df: DataFrame, by: list[str] | None = None, precision: int = PRECISION) -> DataFrame:
    """One row per ``by`` and ``day`` (NULL for unreadable times). Amounts and keys that are missing don't count."""
    ts = F.try_to_timestamp("trans_date_trans_time", F.lit(TIMESTAMP_FORMAT))
    sketches = [F.hll_sketch_agg(F.col(k).cast("string"), precision).alias(name) for k, name in KEYS.items()]
    return (
        df.withColumns({"_ts": ts, "day": F.to_date(ts)})
        .groupBy(*(by or []), "day")
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.count(LABEL).alias("labelled"),
            F.sum(F.col(LABEL).cast("bigint")).alias("fraud_rows"),
            F.min("amt").alias("amt_min"),
            F.max("amt").alias("amt_max"),
            F.sum("amt").alias("amt_sum"),
            F.count("amt").alias("amounts"),
            F.min("_ts").alias("time_from"),
            F.max("_ts").alias("time_to"),
            *sketches,
        )
    )


def store_days(summaries: DataFrame, path: str) -> None:
    """Write daily summaries below ``path``; a day that is there already is replaced, others are left alone."""
    summaries.repartition("day").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        "day"
    ).parquet(path)


def read_days(spark: SparkSession, path: str, first: str | None = None, last: str | None = None) -> DataFrame:
    """Stored days from ``first`` to ``last``; only their folders are read."""
    days = spark.read.parquet(path).withColumn("day", F.col("day").cast("date"))
    if first is not None:
        days = days.where(F.col("day") >= F.lit(first).cast("date"))
    if last is not None:
        days = days.where(F.col("day") <= F.lit(last).cast("date"))
    return days


def unite_summaries(days: DataFrame, by: list[str] | None = None) -> DataFrame:
    """The columns of ``dataset_summary`` over all given days; distinct counts are estimates, the others exact."""

    def estimate(name: str) -> Column:
        return F.hll_sketch_estimate(F.hll_union_agg(name)).alias(name)

    iso = "yyyy-MM-dd'T'HH:mm:ss"
    return days.groupBy(*(by or [])).agg(
        F.sum("rows").alias("rows"),
        F.sum("fraud_rows").alias("fraud_rows"),
        F.try_divide(F.sum("fraud_rows"), F.sum("labelled")).alias("fraud_rate"),
        F.min("amt_min").alias("amt_min"),
        F.try_divide(F.sum("amt_sum"), F.sum("amounts")).alias("amt_mean"),
        F.max("amt_max").alias("amt_max"),
        F.date_format(F.min("time_from"), iso).alias("time_from"),
        F.date_format(F.max("time_to"), iso).alias("time_to"),
        *[estimate(name) for name in KEYS.values()],
    )


def relative_errors(estimated: DataFrame, exact: DataFrame, by: list[str]) -> DataFrame:
    """``(by..., key, exact, error)``: how far each united distinct count is off, as a share of the exact count."""
    names = list(KEYS.values())
    long = [d.unpivot(by, names, "key", v) for d, v in ((estimated, "estimate"), (exact, "exact"))]
    off = F.abs(F.col("estimate") - F.col("exact"))
    return long[0].join(long[1], [*by, "key"]).select(*by, "key", "exact", F.try_divide(off, F.col("exact")).alias("error"))
