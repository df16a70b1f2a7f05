"""Population stability of numeric columns and share shifts of categories."""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardwarden.operators.drift import category_counts
from cardwarden.operators.ordered import exact_quantiles

# Default warning and alert levels.
PSI_WARN, PSI_ALERT = 0.10, 0.20
SHARE_WARN, SHARE_ALERT = 0.10, 0.20
SHARE_FLOOR = 1e-4


def level(value: Column, warn: float, alert: float) -> Column:
    return F.when(value >= alert, F.lit("alert")).when(value >= warn, F.lit("warn")).otherwise(F.lit("ok"))


def population_stability(
    df: DataFrame,
    features: list[str],
    bins: int = 10,
    warn: float = PSI_WARN,
    alert: float = PSI_ALERT,
    buckets: int | None = None,
) -> DataFrame:
    """``(feature, psi, status)``; bins are cut at exact reference quantiles.

    Empty bins count with a share of ``SHARE_FLOOR``; a side without any value gives NULL and ``no data``. The quantiles (``bins - 1`` numbers per
    feature) become constants of the counting pass.
    """
    steps = [i / bins for i in range(1, bins)]
    reference = df.where(F.col("side") == "ref")
    edges: dict[str, list[float]] = {f: [] for f in features}
    for r in exact_quantiles(reference, features, steps, buckets).collect():
        edges[r["feature"]].append(r["value"])
    inf = float("inf")
    usable = [f for f in features if edges[f]]
    numbers = df.select("side", *[F.nanvl(F.col(f).cast("double"), F.lit(None).cast("double")).alias(f) for f in usable])
    binned = Bucketizer(
        inputCols=usable,
        outputCols=[f"{f}_bin" for f in usable],
        splitsArray=[[-inf, *sorted(set(edges[f])), inf] for f in usable],
        handleInvalid="keep",
    ).transform(numbers)
    long = (
        binned.select("side", *[F.when(F.col(f).isNotNull(), F.col(f"{f}_bin").cast("int")).alias(f) for f in usable])
        .unpivot(["side"], usable, "feature", "bin")
        .where(F.col("bin").isNotNull())
    )
    # Totals per feature come from the same few counts: one row per feature and bin.
    counts = long.groupBy("feature", "bin").agg(
        F.count_if(F.col("side") == "ref").alias("n_ref"), F.count_if(F.col("side") == "cur").alias("n_cur")
    )
    totals = counts.groupBy("feature").agg(F.sum("n_ref").alias("ref_all"), F.sum("n_cur").alias("cur_all"))
    floor = F.lit(SHARE_FLOOR)
    r = F.greatest(F.try_divide("n_ref", "ref_all"), floor)
    c = F.greatest(F.try_divide("n_cur", "cur_all"), floor)
    return (
        counts.join(F.broadcast(totals), "feature")
        .groupBy("feature")
        .agg(F.sum(F.when((F.col("ref_all") > 0) & (F.col("cur_all") > 0), (c - r) * F.log(c / r))).alias("psi"))
        .withColumn("status", F.when(F.col("psi").isNull(), F.lit("no data")).otherwise(level(F.col("psi"), warn, alert)))
    )


def category_share_shift(
    df: DataFrame, column: str, warn: float = SHARE_WARN, alert: float = SHARE_ALERT
) -> DataFrame:
    """Share of every category on both sides and how far it moved."""
    counts = category_counts(df, column)
    totals = counts.agg(F.sum("n_ref").alias("ref_all"), F.sum("n_cur").alias("cur_all")).first()
    ref = F.try_divide(F.col("n_ref"), F.lit(totals["ref_all"]))
    cur = F.try_divide(F.col("n_cur"), F.lit(totals["cur_all"]))
    return counts.select(
        "category_value", ref.alias("ref_share"), cur.alias("cur_share"), F.abs(cur - ref).alias("share_diff")
    ).withColumn(
        "status",
        F.when(F.col("share_diff").isNull(), F.lit("no data")).otherwise(level(F.col("share_diff"), warn, alert)),
    )
