"""Distribution and target drift between two (or more) parts of a table.

Parts are told apart by a ``side`` column, so one scan serves all parts and one plan all features.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardwarden.functions import pvalues
from cardwarden.operators.ordered import (
    LEVELS,
    PARTS,
    ROWS_PER_BUCKET,
    add_buckets,
    bucket_offsets,
    cut_again,
    feature_names,
    pruning_buckets,
    running_totals,
    to_long,
)
from cardwarden.schema import LABEL
from cardwarden.session import setting, settle

KS_NAME, CHI2_NAME = "Kolmogorov-Smirnov", "Chi-Square"


def two_sides(reference: DataFrame, current: DataFrame, columns: list[str]) -> DataFrame:
    """Both tables below each other with ``side`` = ``ref`` or ``cur``."""
    return reference.select(*columns, F.lit("ref").alias("side")).unionByName(
        current.select(*columns, F.lit("cur").alias("side"))
    )


def shared_numeric(reference: DataFrame, current: DataFrame) -> list[str]:
    """Numeric columns of the reference that the current table has as well, label included."""
    return [
        f.name
        for f in reference.schema.fields
        if isinstance(f.dataType, T.NumericType) and f.name in current.columns
    ]


#: Most cells of a level of cuts (they are broadcast: some 60 bytes each), and the share of all rows below which sorting is
#: no longer worth avoiding.
MOST_CELLS, SMALL_SHARE = 400_000, 0.02


@dataclass
class Narrowed:
    """What is left to sort: ``rows`` by ``(feature, bucket)``, the open ``cells`` with their offsets, the best distances
    seen at finer borders, and the numbers of rows in open cells and in all."""

    rows: DataFrame
    cells: DataFrame
    borders: DataFrame
    left: int
    total: int


def _start(a: str, b: str) -> Column:
    return F.col(f"n_{a}_before") / F.col(f"n_{a}_all") - F.col(f"n_{b}_before") / F.col(f"n_{b}_all")


def _own(side: str) -> Column:
    return F.col(f"n_{side}") / F.col(f"n_{side}_all")


def _bounded(cells: DataFrame, pairs: list[tuple[str, str]], known: dict[str, Column]) -> DataFrame:
    """Append ``border_<a>_<b>``, the feature's best distance at any border so far, and ``open``: whether the inside of
    the cell can exceed it for some pair. A cell of a single value has no inside."""
    feature = Window.partitionBy("feature")
    borders = {
        f"border_{a}_{b}": F.greatest(
            known.get(f"border_{a}_{b}", F.lit(0.0)), F.max(F.abs(_start(a, b) + _own(a) - _own(b))).over(feature)
        )
        for a, b in pairs
    }
    limits = [F.greatest(F.abs(_start(a, b) + _own(a)), F.abs(_start(a, b) - _own(b))) > F.col(f"border_{a}_{b}") for a, b in pairs]
    return cells.withColumns(borders).withColumn("open", reduce(Column.__or__, limits) & (F.col("low") < F.col("high")))


def narrow(
    long: DataFrame, cells: DataFrame, columns: list[str], pairs: list[tuple[str, str]], counts: list[Column], levels: int = LEVELS
) -> Narrowed:
    """Cut the open cells at their own approximate quantiles and count again, level by level, until few rows are left in
    cells that can hold the maximum. Counting combines in the tasks; nothing is sorted, and borders influence speed only."""
    total = cells.agg(F.sum(sum(F.col(c) for c in columns))).first()[0] or 0
    keep = [f"border_{a}_{b}" for a, b in pairs]
    small = setting(cells.sparkSession, "rowsPerBucket", ROWS_PER_BUCKET)
    finer = cells.groupBy("feature").agg(*[F.max(c).alias(c.replace("border", "finer")) for c in keep])
    open_, rows = cells.where("open"), long
    for level in range(levels + 1):
        found = open_.agg(F.count(F.lit(1)), F.sum(sum(F.col(c) for c in columns))).first()
        left = found[1] or 0
        if level == levels or left <= max(small, SMALL_SHARE * total) or found[0] * PARTS > MOST_CELLS:
            break
        rows = cut_again(rows, open_)
        parents = open_.select(
            "feature", F.col("bucket").alias("parent"), *keep, *[f"{c}_all" for c in columns],
            *[F.col(f"{c}_before").alias(f"{c}_first") for c in columns],
        )
        counted = rows.groupBy("feature", "parent", "bucket").agg(*counts).join(F.broadcast(parents), ["feature", "parent"])
        before = Window.partitionBy("feature", "parent").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
        offsets = {f"{c}_before": F.col(f"{c}_first") + F.coalesce(F.sum(c).over(before), F.lit(0)) for c in columns}
        known = {c: F.max(f"known_{c}").over(Window.partitionBy("feature")) for c in keep}
        located = counted.withColumns(offsets).withColumnsRenamed({c: f"known_{c}" for c in keep})
        cells = settle(_bounded(located, pairs, known).select("feature", "bucket", "low", "high", *columns, *offsets, *[f"{c}_all" for c in columns], *keep, "open"))
        newer = cells.groupBy("feature").agg(*[F.max(c).alias(c) for c in keep])
        finer = settle(
            finer.join(newer, "feature", "left").select(
                "feature", *[F.greatest(f, F.coalesce(c, F.lit(0.0))).alias(f) for c in keep for f in [c.replace("border", "finer")]]
            )
        )
        open_, rows = cells.where("open"), rows.drop("parent")
    return Narrowed(rows, open_, finer, left, total)


def ks_distances(
    df: DataFrame,
    features: list[str],
    sides: list[str],
    pairs: list[tuple[str, str]],
    buckets: int | None = None,
) -> DataFrame:
    """Exact two-sample distances, one row per feature with rows on both sides of every pair.

    Columns: ``feature, n_<side>..., ks_<a>_<b>...``. On a large table a first pass counts rows per
    bucket, which gives the distance at all bucket borders and, for the inside of a bucket, an
    upper limit. Buckets whose limit exceeds the best border distance are cut and counted again, see :func:`narrow`;
    only what is open at the end is shuffled and sorted row by row, the rest cannot hold the maximum. ``df`` is read
    three times and twice more for each level, so it should be a stored table.
    """
    columns = [f"n_{s}" for s in sides]
    wide = df.select("side", *features).where(F.col("side").isin(sides))
    buckets = pruning_buckets(wide) if buckets is None else buckets
    long = to_long(add_buckets(wide, features, buckets), ["side"], features)

    def side_counts() -> list[Column]:
        return [F.count_if(F.col("side") == s).alias(f"n_{s}") for s in sides]

    def share(side: str, suffix: str) -> Column:
        return F.col(f"n_{side}{suffix}") / F.col(f"n_{side}_all")

    def distance(a: str, b: str, suffix: str) -> Column:
        return F.abs(share(a, suffix) - share(b, suffix))

    if buckets <= 1:
        collapsed = long.groupBy("feature", "bucket", "value").agg(*side_counts())
        running = running_totals(collapsed, ["feature"], columns, buckets=1)
        result = (
            running.where(reduce(Column.__and__, [F.col(f"{c}_all") > 0 for c in columns]))
            .groupBy("feature")
            .agg(
                *[F.max(f"{c}_all").alias(c) for c in columns],
                *[F.max(distance(a, b, "_upto")).alias(f"ks_{a}_{b}") for a, b in pairs],
            )
        )
        return feature_names(result, features)

    extent = [F.min("value").alias("low"), F.max("value").alias("high")]
    totals = long.groupBy("feature", "bucket").agg(*side_counts(), *extent)
    offsets = bucket_offsets(totals, ["feature"], columns).where(
        reduce(Column.__and__, [F.col(f"{c}_all") > 0 for c in columns])
    )

    cells = settle(_bounded(offsets, pairs, {}))
    outer = cells.groupBy("feature").agg(
        *[F.max(f"{c}_all").alias(c) for c in columns], *[F.max(f"border_{a}_{b}").alias(f"border_{a}_{b}") for a, b in pairs]
    )
    narrowed = narrow(long, cells, columns, pairs, [*side_counts(), *extent])
    rows, open_cells, outer = narrowed.rows, narrowed.cells, outer.join(narrowed.borders, "feature", "left").select(
        "feature", *columns,
        *[F.greatest(f"border_{a}_{b}", F.coalesce(f"finer_{a}_{b}", F.lit(0.0))).alias(f"border_{a}_{b}") for a, b in pairs],
    )
    # Never more than features x buckets, or MOST_CELLS, entries.
    rows = rows.join(F.broadcast(open_cells.select("feature", "bucket")), ["feature", "bucket"], "left_semi")
    collapsed = rows.groupBy("feature", "bucket", "value").agg(*side_counts())
    inside = running_totals(
        collapsed, ["feature"], columns, offsets=open_cells.select("feature", "bucket", *[c for m in columns for c in (m, f"{m}_before", f"{m}_all")])
    )
    inner = inside.groupBy("feature").agg(
        *[
            F.max(distance(a, b, "_upto")).alias(f"inner_{a}_{b}")
            for a, b in pairs
        ]
    )
    result = outer.join(inner, "feature", "left").select(
        "feature",
        *columns,
        *[
            F.greatest(f"border_{a}_{b}", F.coalesce(f"inner_{a}_{b}", F.lit(0.0))).alias(f"ks_{a}_{b}")
            for a, b in pairs
        ],
    )
    return feature_names(result, features)


def ks_p_value(statistic: Column, n: Column, m: Column, method: str = "asymptotic") -> Column:
    """``asymptotic`` or ``exact``, for samples of any size; the method never changes by itself."""
    if method == "asymptotic":
        return pvalues.ks_asymptotic(statistic, n, m)
    if method == "exact":
        return pvalues.ks_exact(statistic, n, m)
    raise ValueError(f"unknown p-value method: {method}")


def apart(distances: DataFrame, features: list[str], p_method: str) -> DataFrame:
    """Exact p-values of large samples take seconds each, so every feature gets a task of its own."""
    return distances.repartition(len(features)) if p_method == "exact" and features else distances


def feature_drift(
    df: DataFrame,
    features: list[str],
    threshold: float = 0.05,
    p_method: str = "asymptotic",
    buckets: int | None = None,
) -> DataFrame:
    """``(feature, test, statistic, p_value, drifted, threshold)`` between ``ref`` and ``cur``.

    Missing values are left out; a feature without values on one side does not appear.
    """
    distances = apart(ks_distances(df, features, ["ref", "cur"], [("ref", "cur")], buckets), features, p_method)
    p = ks_p_value(F.col("ks_ref_cur"), F.col("n_ref"), F.col("n_cur"), p_method)
    return distances.select(
        "feature",
        F.lit(KS_NAME).alias("test"),
        F.col("ks_ref_cur").alias("statistic"),
        p.alias("p_value"),
    ).select(
        "*", (F.col("p_value") < threshold).alias("drifted"), F.lit(float(threshold)).alias("threshold")
    )


def category_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per category on both sides, 0 where a side lacks it; one shuffle for both sides."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("category_value"))
        .agg(
            F.count_if(F.col("side") == "ref").alias("n_ref"),
            F.count_if(F.col("side") == "cur").alias("n_cur"),
        )
    )


def category_drift(
    df: DataFrame, columns: list[str], threshold: float = 0.05, scale_expected: bool = True
) -> DataFrame:
    """Chi-square goodness of fit of the current counts against the reference counts.

    With ``scale_expected`` the reference counts are scaled to the current total; without it,
    unequal totals are an error of the input and give a NULL statistic. Categories without a
    reference row have no expected count: they are reported in ``new_categories`` and make the
    statistic infinite.
    """
    narrow = df.select("side", *[F.col(c).cast("string").alias(c) for c in columns])
    long = narrow.unpivot(["side"], columns, "feature", "category_value")
    counts = (
        long.where(F.col("category_value").isNotNull())
        .groupBy("feature", "category_value")
        .agg(
            F.count_if(F.col("side") == "ref").alias("n_ref"),
            F.count_if(F.col("side") == "cur").alias("n_cur"),
        )
    )
    # One row per listed column, so this side of the join is always tiny.
    totals = counts.groupBy("feature").agg(
        F.sum("n_ref").alias("ref_all"), F.sum("n_cur").alias("cur_all")
    )
    scale = F.col("cur_all") / F.col("ref_all") if scale_expected else F.lit(1.0)
    expected = F.col("n_ref") * scale
    term = F.when(F.col("n_ref") > 0, F.pow(F.col("n_cur") - expected, 2) / expected)
    sums = (
        counts.join(F.broadcast(totals), "feature")
        .where((F.col("ref_all") > 0) & (F.col("cur_all") > 0))
        .groupBy("feature", "ref_all", "cur_all")
        .agg(
            F.count(F.lit(1)).alias("categories"),
            F.count_if(F.col("n_ref") == 0).alias("new_categories"),
            F.sum(term).alias("_sum"),
        )
    )
    statistic = F.when(F.col("new_categories") > 0, F.lit(float("inf"))).otherwise(F.col("_sum"))
    if not scale_expected:
        statistic = F.when(F.col("cur_all") == F.col("ref_all"), statistic)
    tested = sums.select(
        "feature",
        F.lit(CHI2_NAME).alias("test"),
        statistic.alias("statistic"),
        F.col("categories"),
        F.col("new_categories"),
    )
    p = F.when(
        F.col("statistic").isNotNull(),
        pvalues.chi2_sf(F.coalesce("statistic", F.lit(0.0)), F.col("categories") - 1),
    )
    return tested.withColumn("p_value", p).select(
        "*", (F.col("p_value") < threshold).alias("drifted"), F.lit(float(threshold)).alias("threshold")
    )


def distribution_drift(
    df: DataFrame, column: str, method: str = "ks", threshold: float = 0.05, **options
) -> DataFrame:
    """One column, by method name."""
    if method == "ks":
        return feature_drift(df, [column], threshold, **options)
    if method == "chi2":
        return category_drift(df, [column], threshold, **options)
    raise ValueError(f"unknown drift method: {method}")


def target_drift(df: DataFrame, label: str = LABEL, threshold: float = 0.05) -> DataFrame:
    """Positive rates of both sides and the two-sided exact binomial p of the current positives."""
    is_ref, is_cur = F.col("side") == "ref", F.col("side") == "cur"
    y = F.col(label).cast("bigint")
    counts = df.agg(
        F.avg(F.when(is_ref, y)).alias("reference_fraud_rate"),
        F.sum(F.when(is_cur, y)).alias("_k"),
        F.count_if(is_cur).alias("_n"),
    ).withColumn("current_fraud_rate", F.try_divide(F.col("_k"), F.col("_n")))
    return counts.select(
        "reference_fraud_rate",
        "current_fraud_rate",
        (F.col("current_fraud_rate") - F.col("reference_fraud_rate")).alias("fraud_rate_change"),
        # Without rows or labels on a side there is nothing to test.
        F.when(
            F.col("reference_fraud_rate").isNotNull() & F.col("current_fraud_rate").isNotNull(),
            pvalues.binomial_p(
                F.coalesce("_k", F.lit(0)), F.col("_n"), F.coalesce("reference_fraud_rate", F.lit(0.0))
            ),
        ).alias("p_value"),
    ).select("*", (F.col("p_value") < threshold).alias("drifted"), F.lit(float(threshold)).alias("threshold"))


def drift_summary(results: DataFrame) -> DataFrame:
    """Checked and drifted features over a result table of one row per feature."""
    return results.agg(
        F.count(F.lit(1)).alias("total_features_checked"),
        F.count_if("drifted").alias("features_with_drift"),
        F.array_sort(F.collect_list(F.when(F.col("drifted"), F.col("feature")))).alias(
            "drifted_feature_names"
        ),
        F.coalesce(F.bool_or("drifted"), F.lit(False)).alias("overall_drift_detected"),
    )


def split_shift(df: DataFrame, features: list[str], p_method: str = "asymptotic", buckets: int | None = None) -> DataFrame:
    """Distances train-validation and train-test per feature, from one set of running totals."""
    sided = df.withColumnRenamed("split", "side")
    d = apart(ks_distances(sided, features, ["train", "val", "test"], [("train", "val"), ("train", "test")], buckets), features, p_method)
    return d.select(
        "feature",
        "ks_train_val",
        ks_p_value(F.col("ks_train_val"), F.col("n_train"), F.col("n_val"), p_method).alias("p_train_val"),
        "ks_train_test",
        ks_p_value(F.col("ks_train_test"), F.col("n_train"), F.col("n_test"), p_method).alias("p_train_test"),
    )
