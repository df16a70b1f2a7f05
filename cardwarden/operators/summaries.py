"""Descriptive aggregates of transaction, split and score tables."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardwarden.operators.ordered import exact_quantiles
from cardwarden.schema import FEATURE_GROUPS, GROUP_STATS, LABEL, TIMESTAMP_FORMAT


def dataset_summary(df: DataFrame, by: list[str] | None = None, approximate: bool = False) -> DataFrame:
    """Rows, positives, amount range, time range and distinct keys in one aggregation."""
    ts = F.to_timestamp("trans_date_trans_time", TIMESTAMP_FORMAT)
    iso = "yyyy-MM-dd'T'HH:mm:ss"
    distinct = F.approx_count_distinct if approximate else F.count_distinct
    return df.groupBy(*(by or [])).agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(F.col(LABEL).cast("bigint")).alias("fraud_rows"),
        F.avg(LABEL).alias("fraud_rate"),
        F.min("amt").alias("amt_min"),
        F.avg("amt").alias("amt_mean"),
        F.max("amt").alias("amt_max"),
        F.date_format(F.min(ts), iso).alias("time_from"),
        F.date_format(F.max(ts), iso).alias("time_to"),
        distinct(F.col("cc_num")).alias("unique_cards"),
        distinct(F.col("merchant")).alias("unique_merchants"),
        distinct(F.col("category")).alias("unique_categories"),
    )


def split_summary(df: DataFrame, label: str = LABEL) -> DataFrame:
    """Rows, positives and positive rate per split."""
    return df.groupBy("split").agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(F.col(label).cast("bigint")).alias("fraud_rows"),
        F.avg(label).alias("fraud_rate"),
    )


def class_distribution(df: DataFrame, label: str = LABEL) -> DataFrame:
    """Rows and percentage of every class inside its split."""
    counts = df.groupBy("split", label).agg(F.count(F.lit(1)).alias("rows"))
    # The window runs over one row per split and class.
    total = F.sum("rows").over(Window.partitionBy("split"))
    return counts.withColumn("percent", F.col("rows") * 100.0 / total)


def feature_profile(df: DataFrame) -> DataFrame:
    """Min, mean and max of every catalogued feature, one wide pass."""
    names = [(g, n) for g, ns in FEATURE_GROUPS.items() for n in ns if n in df.columns]
    wide = df.agg(
        *[f(F.col(n).cast("double")).alias(f"{n}__{k}") for _, n in names for k, f in
          (("min", F.min), ("mean", F.avg), ("max", F.max))]
    )
    entries = [
        F.struct(
            F.lit(g).alias("feature_group"),
            F.lit(n).alias("feature"),
            *[F.col(f"{n}__{k}").alias(f"{k}_value") for k in ("min", "mean", "max")],
        )
        for g, n in names
    ]
    return wide.select(F.inline(F.array(*entries)))


def class_weights(df: DataFrame, label: str = LABEL) -> DataFrame:
    """Imbalance weights: negatives per positive, and balanced weights of both classes."""
    return df.agg(
        F.count_if(F.col(label) == 0).alias("negatives"), F.count_if(F.col(label) == 1).alias("positives")
    ).select(
        "negatives",
        "positives",
        (F.col("negatives") / F.greatest("positives", F.lit(1))).alias("scale_pos_weight"),
        F.try_divide(F.col("negatives") + F.col("positives"), 2 * F.col("negatives")).alias("weight_0"),
        F.try_divide(F.col("negatives") + F.col("positives"), 2 * F.col("positives")).alias("weight_1"),
    )


def serving_defaults(train: DataFrame, buckets: int | None = None) -> DataFrame:
    """Exact row-weighted medians ``(feature, value)`` of the group statistics in ``train``.

    Statistics the table lacks fall back to the amount's mean or deviation, one or zero.
    """
    present = [c for c in GROUP_STATS if c in train.columns]
    absent = [c for c in GROUP_STATS if c not in train.columns]
    parts = []
    if present:
        parts.append(exact_quantiles(train, present, [0.5], buckets).select("feature", "value"))
    if absent:
        stats = train.agg(F.avg("amt").alias("avg_amt"), F.stddev_samp("amt").alias("std_amt"))
        fallback = {
            "avg_amt": F.col("avg_amt"),
            "std_amt": F.col("std_amt"),
            "txn_count": F.lit(1.0),
            "fraud_rate": F.lit(0.0),
        }
        entries = [
            F.struct(F.lit(c).alias("feature"), fallback[c.split("_", 1)[1]].alias("value")) for c in absent
        ]
        parts.append(stats.select(F.inline(F.array(*entries))))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def score_summary(decisions: DataFrame) -> DataFrame:
    """Scored rows, positives and positive share of a batch."""
    return decisions.agg(
        F.count(F.lit(1)).alias("scored"), F.count_if(F.col("is_fraud")).alias("flagged")
    ).withColumn("flagged_rate", F.col("flagged") / F.greatest("scored", F.lit(1)))


def outcome_counts(decisions: DataFrame, by: list[str] | None = None) -> DataFrame:
    outcome = F.when(F.col("is_fraud"), F.lit("fraud")).otherwise(F.lit("legit")).alias("outcome")
    return decisions.groupBy(*(by or []), outcome).agg(F.count(F.lit(1)).alias("predictions"))


#: Upper ends of latency buckets in seconds (fixed values: the usual defaults of request histograms).
LATENCY_BOUNDS = [0.005, 0.01, 0.025, 0.05, 0.075, 0.1, 0.25, 0.5, 0.75, 1.0, 2.5, 5.0, 7.5, 10.0]


def bucket_of(value: Column, bounds: list[float]) -> Column:
    """The smallest bound that is not below the value; infinity beyond the last."""
    return F.coalesce(F.get(F.filter(F.array(*map(F.lit, bounds)), lambda b: b >= value), F.lit(0)), F.lit(math.inf))


def histogram(df: DataFrame, value: str, bounds: list[float], by: list[str] | None = None) -> DataFrame:
    """``(by, le, n)``: observations per bucket. Counts of parts of the data simply add up."""
    some = df.where(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double")))
    return some.groupBy(*(by or []), bucket_of(F.col(value).cast("double"), bounds).alias("le")).agg(F.count(F.lit(1)).alias("n"))


def histogram_quantile(buckets: DataFrame, bounds: list[float], q: float, by: list[str] | None = None, name: str = "value") -> DataFrame:
    """``(by, <name>, observations)`` by interpolation inside the bucket that holds rank ``q * n``.

    The first bucket begins at zero if its bound is positive; a rank beyond the last bound gives that bound. The error is
    at most one bucket's width, whatever the number of observations; a group is at most one row per bucket.
    """
    ends = [float(b) for b in bounds]
    counts = F.map_from_entries(F.collect_list(F.struct("le", "n")))
    whole = buckets.groupBy(*(by or []), "le").agg(F.sum("n").alias("n")).groupBy(*(by or [])).agg(counts.alias("c"))
    at = [F.coalesce(F.try_element_at("c", F.lit(b)), F.lit(0)).cast("double") for b in [*ends, math.inf]]
    upto = [sum(at[1 : i + 1], at[0]) for i in range(len(at))]
    rank = F.lit(float(q)) * upto[-1]
    # From the last bucket to the first, so that the first that reaches the rank decides.
    out = F.lit(ends[-1])
    for i in reversed(range(len(ends))):
        low = ends[i - 1] if i else (0.0 if ends[0] > 0 else ends[0])
        before = upto[i - 1] if i else F.lit(0.0)
        inside = F.lit(low) + F.lit(ends[i] - low) * F.coalesce(F.try_divide(rank - before, at[i]), F.lit(0.0))
        out = F.when(upto[i] >= rank, inside).otherwise(out)
    return whole.select(*(by or []), out.alias(name), upto[-1].cast("bigint").alias("observations"))


def exact_p95(df: DataFrame, column: str, buckets: int | None = None) -> DataFrame:
    return exact_quantiles(df, [column], [0.95], buckets).select(F.col("value").alias("p95"))
