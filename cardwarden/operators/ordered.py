"""Order statistics without a global sort.

Ranking curves, two-sample distances and exact quantiles all need running totals over an ordered
column. A window without partitions would run them in one task. Here the value range is cut into
buckets at approximate quantiles; only bucket totals are added up per group, and rows are sorted
inside their bucket. Bucket borders decide where work is done, never what comes out, because equal
values always share a bucket and bucket order is value order.
"""

from __future__ import annotations

import math

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardwarden.session import setting, settle, settle_table

#: Rows that one task sorts comfortably; below it a table needs no buckets at all. Setting ``rowsPerBucket``.
ROWS_PER_BUCKET = 1_000_000
#: Keeps the quantile sketch of one task at a few hundred kB per column; more buckets are cut in a second
#: level. Setting ``bucketsPerLevel``.
BUCKETS_PER_LEVEL = 4096
#: Operators that skip most buckets begin with this many of them, and cut those that they can't skip again.
PRUNING_BUCKETS = 256
#: Parts of a bucket that is cut again, most levels of such cuts, and the share of all rows below which sorting is no
#: longer worth avoiding (of a few quantiles' buckets).
PARTS, LEVELS, FEW_ROWS = 32, 3, 0.05
#: Sketches that Spark's aggregation keeps in memory before it sorts its rows.
SKETCHES = 128


def choose_buckets(
    df: DataFrame, at_least: int = 1, rows_per_bucket: int | None = None
) -> int:
    """Buckets by counted size: one for a small table, otherwise ``at_least`` and by rows.

    Inputs that are costly to recompute should be stored first.
    """
    size = rows_per_bucket or setting(df.sparkSession, "rowsPerBucket", ROWS_PER_BUCKET)
    needed = math.ceil(df.count() / size)
    return 1 if needed <= 1 else max(needed, at_least)


def pruning_buckets(df: DataFrame) -> int:
    """Buckets of one level: one for a small table, otherwise up to ``PRUNING_BUCKETS``, however large the table is."""
    return 1 if choose_buckets(df) <= 1 else min(PRUNING_BUCKETS, setting(df.sparkSession, "bucketsPerLevel", BUCKETS_PER_LEVEL))


def add_passed(df: DataFrame, searches: dict[str, tuple[str, Column]], most: int) -> DataFrame:
    """Append for each name how many borders of an ascending array column, ``most`` of them at most, are not above the value
    (0 without an array). One projection a halving: the generated code looks at a few borders and copies no array."""
    found = df.withColumns({name: F.lit(0) for name in searches})
    for step in [1 << bit for bit in reversed(range(most.bit_length()))]:
        found = found.withColumns(
            {
                name: F.when(F.get(borders, F.col(name) + (step - 1)) <= value, F.col(name) + step).otherwise(F.col(name))
                for name, (borders, value) in searches.items()
            }
        )
    return found


def cut_again(rows: DataFrame, cells: DataFrame) -> DataFrame:
    """The rows of some ``(feature, bucket)`` cells, each cut into up to ``PARTS`` at its own approximate quantiles: ``bucket``
    becomes ``parent``, and the new one is numbered in value order. The cells are broadcast."""
    kept = rows.join(F.broadcast(cells.select("feature", "bucket")), ["feature", "bucket"], "left_semi")
    steps = [i / PARTS for i in range(1, PARTS)]
    cuts = F.array_distinct(F.percentile_approx("value", steps, 4 * PARTS)).alias("_cuts")
    borders = settle(kept.groupBy("feature", "bucket").agg(cuts))
    found = add_passed(rows.join(F.broadcast(borders), ["feature", "bucket"]), {"_passed": ("_cuts", F.col("value"))}, PARTS - 1)
    return found.select(
        *[c for c in rows.columns if c != "bucket"], F.col("bucket").alias("parent"),
        # Never missing: otherwise each join on it would repeat the whole search in a condition.
        (F.coalesce(F.col("bucket").cast("bigint"), F.lit(0)) * PARTS + F.col("_passed")).alias("bucket"),
    )


def add_buckets(df: DataFrame, columns: list[str], buckets: int) -> DataFrame:
    """Append ``<column>_bucket`` for each column: an order-preserving bucket number.

    One pass merges quantile sketches of all columns as a tree; at most ``columns x BUCKETS_PER_LEVEL`` borders
    reach the driver. Beyond that many buckets each one is cut again. Values are compared as doubles; missing
    values get a bucket nobody reads.
    """
    level = setting(df.sparkSession, "bucketsPerLevel", BUCKETS_PER_LEVEL)
    if buckets > level:
        return _refined(add_buckets(df, columns, level), columns, math.ceil(buckets / level))
    if buckets <= 1:
        return df.withColumns({f"{c}_bucket": F.lit(0.0) for c in columns})
    number = {c: _number(c) for c in columns}
    steps = [i / buckets for i in range(1, buckets)]
    sketch = df.select(*[number[c].alias(c) for c in columns]).approxQuantile(
        columns, steps, 0.5 / buckets
    )
    borders = {c: sorted(set(quantiles)) for c, quantiles in zip(columns, sketch)}
    cut = [c for c in columns if borders[c]]
    marked = df.withColumns(
        {
            **{f"{c}_value": number[c] for c in cut},
            **{f"{c}_bucket": F.lit(0.0) for c in columns if not borders[c]},
        }
    )
    if cut:
        marked = Bucketizer(
            inputCols=[f"{c}_value" for c in cut],
            outputCols=[f"{c}_bucket" for c in cut],
            splitsArray=[[-math.inf, *borders[c], math.inf] for c in cut],
            handleInvalid="keep",
        ).transform(marked)
    return marked.drop(*[f"{c}_value" for c in cut])


def _refined(marked: DataFrame, columns: list[str], parts: int) -> DataFrame:
    """Each bucket cut into up to ``parts`` at its own approximate quantiles, numbered in value order.

    A second pass merges one sketch per column and bucket, which the tasks combine before the shuffle. The borders
    of a column are one row per bucket and eight bytes per final bucket: 8 MB for a million of them.
    """
    steps = [i / parts for i in range(1, parts)]
    spark = marked.sparkSession
    # So many columns at once that their sketches are kept in memory; they are as exact as there are parts.
    at_once = max(1, SKETCHES // setting(spark, "bucketsPerLevel", BUCKETS_PER_LEVEL))
    for first in range(0, len(columns), at_once):
        some = columns[first : first + at_once]
        entries = [
            F.struct(F.lit(i).alias("feature"), F.col(f"{c}_bucket").alias("bucket"), _number(c).alias("value"))
            for i, c in enumerate(some)
        ]
        cut = settle_table(
            marked.select(F.inline(F.array(*entries)))
            .where(F.col("value").isNotNull())
            .groupBy("feature", "bucket")
            .agg(F.array_distinct(F.percentile_approx("value", steps, 2 * parts)).alias("borders")),
            "borders",
        )
        for i, c in enumerate(some):
            own = cut.where(F.col("feature") == i).select(
                F.col("bucket").alias(f"{c}_bucket"), F.col("borders").alias(f"{c}_borders")
            )
            # At most BUCKETS_PER_LEVEL rows.
            marked = marked.join(F.broadcast(own), f"{c}_bucket", "left")
        # A missing value passes nothing.
        searches = {f"{c}_passed": (f"{c}_borders", _number(c)) for c in some}
        marked = add_passed(marked, searches, parts - 1).withColumns(
            {f"{c}_bucket": F.coalesce(f"{c}_bucket", F.lit(0.0)) * parts + F.col(f"{c}_passed") for c in some}
        )
        marked = marked.drop(*[f"{c}_{x}" for c in some for x in ("borders", "passed")])
    return marked


def _number(column: str) -> Column:
    """A numeric column as a double, with NaN treated as missing."""
    return F.nanvl(F.col(column).cast("double"), F.lit(None).cast("double"))


def to_long(df: DataFrame, ids: list[str], columns: list[str]) -> DataFrame:
    """Rows ``(ids, feature, bucket, value)`` of bucketed columns, missing values left out.

    ``feature`` is the column's position, which keeps names out of the shuffles;
    :func:`feature_names` restores them on the few result rows. The entries are put together in a projection of
    their own: generated in one piece with what follows, the code would be too long for the JVM to compile.
    """
    entries = [
        F.struct(
            F.lit(i).alias("feature"),
            F.col(f"{c}_bucket").cast("int").alias("bucket"),
            _number(c).alias("value"),
        )
        for i, c in enumerate(columns)
    ]
    present = F.filter(F.array(*entries), lambda e: e["value"].isNotNull())
    # The outer form, since from the inner one Spark infers a condition on the whole array for the scan.
    return df.select(*ids, present.alias("_entries")).select(*ids, F.inline_outer("_entries")).where(F.col("value").isNotNull())


def feature_names(df: DataFrame, columns: list[str]) -> DataFrame:
    """Positions in ``feature`` back to column names."""
    names = F.array(*[F.lit(c) for c in columns])
    return df.withColumn("feature", F.element_at(names, F.col("feature") + 1))


def bucket_offsets(
    totals: DataFrame, by: list[str], measures: list[str], descending: bool = False
) -> DataFrame:
    """Per bucket: ``<m>_before`` (all earlier buckets) and ``<m>_all`` (the whole group).

    ``totals`` has one row per group and bucket, so a window here sorts at most as many rows as
    there are buckets.
    """
    order = F.col("bucket").desc() if descending else F.col("bucket").asc()
    group = Window.partitionBy(*by)
    before = group.orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return totals.withColumns(
        {
            **{f"{m}_before": F.coalesce(F.sum(m).over(before), F.lit(0)) for m in measures},
            **{f"{m}_all": F.sum(m).over(group) for m in measures},
        }
    )


def running_totals(
    collapsed: DataFrame,
    by: list[str],
    measures: list[str],
    descending: bool = False,
    buckets: int = 2,
    offsets: DataFrame | None = None,
) -> DataFrame:
    """Inclusive running totals ``<m>_upto`` and group totals ``<m>_all`` over ``value``.

    ``collapsed`` has one row per ``by + [bucket, value]`` with summed measures. ``offsets`` may be
    passed when ``collapsed`` holds only some of the buckets.
    """
    order = F.col("value").desc() if descending else F.col("value").asc()
    whole = Window.partitionBy(*by, "bucket")
    inside = whole.orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    if buckets <= 1:
        return collapsed.withColumns(
            {
                **{f"{m}_upto": F.sum(m).over(inside) for m in measures},
                **{f"{m}_all": F.sum(m).over(whole) for m in measures},
            }
        )
    if offsets is None:
        totals = collapsed.groupBy(*by, "bucket").agg(*[F.sum(m).alias(m) for m in measures])
        offsets = bucket_offsets(totals, by, measures, descending)
    # Both sides are hash-partitioned by group and bucket, so the join adds no shuffle of rows.
    return (
        collapsed.withColumns({f"{m}_inside": F.sum(m).over(inside) for m in measures})
        .join(offsets.drop(*measures), [*by, "bucket"])
        .withColumns({f"{m}_upto": F.col(f"{m}_before") + F.col(f"{m}_inside") for m in measures})
        .drop(*[f"{m}_inside" for m in measures])
    )


def exact_quantiles(
    df: DataFrame, columns: list[str], fractions: list[float], buckets: int | None = None
) -> DataFrame:
    """Rows ``(feature, fraction, value)`` with linear interpolation between neighbours.

    On a large table a counting pass finds the buckets that hold the wanted ranks; while these are too large for one
    task to sort, they are cut and counted again. Only rows of the last ones are shuffled and sorted. (A plain
    exact percentile keeps every distinct value in one task.)
    """
    narrow = df.select(*columns)
    buckets = pruning_buckets(narrow) if buckets is None else buckets
    long = to_long(add_buckets(narrow, columns, buckets), [], columns)
    wanted = F.explode(F.array(*[F.lit(float(q)) for q in fractions])).alias("fraction")

    def with_ranks(counted: DataFrame, first: Column, last: Column) -> DataFrame:
        """Keep what covers, from rank ``first`` to ``last``, a neighbour of a wanted position."""
        position = F.col("fraction") * (F.col("n_all") - 1)
        return (
            counted.select("*", wanted)
            .withColumns({"position": position, "low": F.floor(position), "high": F.ceil(position)})
            .where(F.col("low").between(first, last) | F.col("high").between(first, last))
        )

    def located(counted: DataFrame) -> DataFrame:
        """At most two buckets per feature and fraction."""
        covering = with_ranks(counted, F.col("n_before"), F.col("n_before") + F.col("n") - 1)
        return settle(covering.select("feature", "bucket", "n", "n_before", "n_all", "several").distinct())

    offsets = None
    if buckets > 1:
        small = setting(df.sparkSession, "rowsPerBucket", ROWS_PER_BUCKET)
        counting = [F.count(F.lit(1)).alias("n"), (F.min("value") < F.max("value")).alias("several")]
        offsets = located(bucket_offsets(long.groupBy("feature", "bucket").agg(*counting), ["feature"], ["n"]))
        for _ in range(LEVELS):
            # Buckets of a single value collapse before they are shuffled.
            of_feature = offsets.groupBy("feature").agg(
                F.max("n_all").alias("all"), F.sum(F.when(F.col("several"), F.col("n"))).alias("left"), F.max(F.when(F.col("several"), F.col("n"))).alias("largest")
            )
            found = of_feature.agg(F.sum("all").alias("all"), F.coalesce(F.sum("left"), F.lit(0)).alias("left"), F.coalesce(F.max("largest"), F.lit(0)).alias("largest")).first()
            if found["largest"] <= small or (found["largest"] <= ROWS_PER_BUCKET and found["left"] <= FEW_ROWS * found["all"]):
                break
            long = cut_again(long, offsets)
            parents = offsets.select("feature", F.col("bucket").alias("parent"), F.col("n_before").alias("n_first"), "n_all")
            counted = long.groupBy("feature", "parent", "bucket").agg(*counting)
            inside = bucket_offsets(counted, ["feature", "parent"], ["n"]).drop("n_all").join(F.broadcast(parents), ["feature", "parent"])
            offsets = located(inside.withColumn("n_before", F.col("n_first") + F.col("n_before")))
            long = long.drop("parent")
        long = long.join(
            F.broadcast(offsets.select("feature", "bucket")), ["feature", "bucket"], "left_semi"
        )
        offsets = offsets.drop("several")
    collapsed = long.groupBy("feature", "bucket", "value").agg(F.count(F.lit(1)).alias("n"))
    ranked = running_totals(collapsed, ["feature"], ["n"], buckets=buckets, offsets=offsets)
    hits = with_ranks(ranked, F.col("n_upto") - F.col("n"), F.col("n_upto") - 1)
    # One or two rows per feature and fraction are left.
    lower, upper = F.min("value"), F.max("value")
    result = hits.groupBy("feature", "fraction", "position", "low").agg(
        (lower + (upper - lower) * (F.col("position") - F.col("low"))).alias("value")
    )
    return feature_names(result, columns).select("feature", "fraction", "value")
