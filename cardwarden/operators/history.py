"""Group statistics without leakage.

Point-in-time statistics use strictly earlier transactions of the same key. Fitted statistics are
learned on one table (the training split) and applied to another.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardwarden.operators.group_stats import (
    GROUPINGS,
    Grouping,
    GroupTables,
    aggregate_groupings,
    join_groupings,
)
from cardwarden.operators.keyed_join import attach_shuffled
from cardwarden.schema import LABEL

#: Width of one time slice of a key; a slice holds at most this many distinct seconds.
SLICE_SECONDS = 86_400


#: Moments of a key's rows: rows, amounts, their mean and summed squared deviations, labels, positives.
MOMENTS = ["n", "k", "mean", "m2", "l", "p"]


def moment_sums(amount: Column, label: str = LABEL) -> list[Column]:
    """The moments of a group of rows; deviations are taken from the group's own mean, so large amounts
    with small differences keep their spread."""
    y = F.col(label).cast("bigint")
    return [
        F.count(F.lit(1)).alias("n"),
        F.count(amount).alias("k"),
        F.coalesce(F.avg(amount), F.lit(0.0)).alias("mean"),
        F.coalesce(F.var_pop(amount) * F.count(amount), F.lit(0.0)).alias("m2"),
        F.count(y).alias("l"),
        F.coalesce(F.sum(y), F.lit(0)).alias("p"),
    ]


def merged_sums() -> list[Column]:
    """Moments of groups of rows put together: deviations add up, plus those of the means."""
    k, mean = F.col("k"), F.col("mean")
    return [
        F.sum("n").alias("n"),
        F.sum("k").alias("k"),
        F.coalesce(F.try_divide(F.sum(k * mean), F.sum("k")), F.lit(0.0)).alias("mean"),
        (F.sum("m2") + _between(k, mean)).alias("m2"),
        F.sum("l").alias("l"),
        F.sum("p").alias("p"),
    ]


def _between(k: Column, mean: Column) -> Column:
    """Squared deviations of the groups' means, each counting ``k`` rows, from their common mean."""
    pairs = F.collect_list(F.when(k > 0, F.struct(k.cast("double").alias("k"), mean.alias("mean"))))
    start = F.struct(F.lit(0.0).alias("k"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("m2"))
    return F.aggregate(pairs, start, lambda a, b: _pair(a["k"], a["mean"], a["m2"], b["k"], b["mean"], F.lit(0.0)))["m2"]


def _pair(k1: Column, mean1: Column, m1: Column, k2: Column, mean2: Column, m2: Column) -> Column:
    """Count, mean and squared deviations of two groups together."""
    k = k1 + k2
    away = mean2 - mean1
    share = F.coalesce(F.try_divide(k2, k), F.lit(0.0))
    return F.struct(
        k.alias("k"), (mean1 + away * share).alias("mean"), (m1 + m2 + away * away * k1 * share).alias("m2")
    )


def added(left: list[Column], right: list[Column]) -> list[Column]:
    """Moments of two disjoint sets of rows together, in the order of ``MOMENTS``."""
    n1, k1, mean1, m1, l1, p1 = left
    n2, k2, mean2, m2, l2, p2 = right
    both = _pair(k1.cast("double"), mean1, m1, k2.cast("double"), mean2, m2)
    return [n1 + n2, k1 + k2, both["mean"], both["m2"], l1 + l2, p1 + p2]


def moment_statistics(
    n: Column, k: Column, mean: Column, m2: Column, labels: Column, p: Column, prefix: str
) -> dict[str, Column]:
    """Count of rows, mean and sample deviation of the amounts, positive rate of the labels; without amounts the
    mean is missing."""
    deviation = F.when(k > 1, F.sqrt(F.try_divide(m2, k - 1))).otherwise(F.lit(0.0))
    return {
        f"{prefix}_txn_count": n,
        f"{prefix}_avg_amt": F.when(k > 0, mean),
        f"{prefix}_std_amt": F.when(n.isNotNull(), deviation),
        f"{prefix}_fraud_rate": F.when(n.isNotNull(), F.coalesce(F.try_divide(p, labels), F.lit(0.0))),
    }


def _before(table: DataFrame, partition: list[str], order: str) -> DataFrame:
    """Append ``<moment>_before``: the moments of all earlier rows of the partition.

    Sums are taken around the partition's earliest mean, which no later row can change.
    """
    over = Window.partitionBy(*partition).orderBy(order)
    whole = over.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    frame = over.rowsBetween(Window.unboundedPreceding, -1)
    first = F.first(F.when(F.col("k") > 0, F.col("mean")), ignorenulls=True).over(whole)
    away = F.col("mean") - F.col("_c")

    def total(x: Column) -> Column:
        return F.coalesce(F.sum(x).over(frame), F.lit(0))

    summed = table.withColumn("_c", F.coalesce(first, F.lit(0.0))).withColumns(
        {
            "n_before": total(F.col("n")),
            "k_before": total(F.col("k")),
            "_s": total(F.col("k") * away),
            "_q": total(F.col("m2") + F.col("k") * away * away),
            "l_before": total(F.col("l")),
            "p_before": total(F.col("p")),
        }
    )
    share = F.coalesce(F.try_divide("_s", "k_before"), F.lit(0.0))
    return summed.withColumns(
        {
            "mean_before": F.when(F.col("k_before") > 0, F.col("_c") + share).otherwise(F.lit(0.0)),
            "m2_before": F.greatest(F.col("_q") - F.col("_s") * share, F.lit(0.0)),
        }
    ).drop("_c", "_s", "_q")


def earlier_moments(
    df: DataFrame,
    key: str,
    time: str = "unix_time",
    amount: str = "amt",
    label: str = LABEL,
    spread_by: list[str] | None = None,
    slice_seconds: int = SLICE_SECONDS,
    rows_per_task: int | None = None,
) -> DataFrame:
    """Append the moments of the key's strictly earlier rows; NULL without a key.

    Rows of one key and second share their history, so they are collapsed first. The collapsed
    seconds of a key are cut into time slices: running sums are taken inside a slice and carried
    over from earlier slices, so that even a key owning most of the table is spread over as many
    tasks as it has slices. Rows without an amount count as rows and with their label.
    """
    sums = moment_sums(F.col(amount), label)
    timed = df.withColumn("_day", F.floor(F.col(time) / F.lit(slice_seconds)))
    keyed = timed.where(F.col(key).isNotNull() & F.col(time).isNotNull())
    # Slice totals come straight from the rows: their partial sums shrink to a row per key and slice.
    slices = keyed.groupBy(key, "_day").agg(*sums)
    carried = _before(slices, [key], "_day").select(
        key, "_day", *[F.col(f"{m}_before").alias(f"{m}_carried") for m in MOMENTS]
    )
    seconds = keyed.groupBy(key, "_day", time).agg(*sums)
    inside = _before(seconds, [key, "_day"], time)
    # ``inside`` is already partitioned by key and slice.
    both = added([F.col(f"{m}_carried") for m in MOMENTS], [F.col(f"{m}_before") for m in MOMENTS])
    history = inside.join(carried, [key, "_day"]).select(
        key, "_day", time, *[c.alias(m) for c, m in zip(both, MOMENTS)]
    )
    # One entry per key and second: never small, so it is not a candidate for a broadcast. Hot
    # slices are found by counting two columns.
    sizes = keyed.groupBy(key, "_day").agg(F.count(F.lit(1)).alias("_rows"))
    joined = attach_shuffled(
        timed, history, [key, time], "_rows", spread_by or ["trans_num"], rows_per_task,
        counts=sizes, counted_by=[key, "_day"],
    )
    return joined.select(*df.columns, *MOMENTS)


def earlier_statistics(
    df: DataFrame,
    key: str,
    time: str = "unix_time",
    amount: str = "amt",
    label: str = LABEL,
    prefix: str = "prior",
    spread_by: list[str] | None = None,
    slice_seconds: int = SLICE_SECONDS,
    rows_per_task: int | None = None,
) -> DataFrame:
    """Append count, mean, deviation and positive rate of the key's strictly earlier rows.

    Rows without earlier ones get count 0, deviation 0, rate 0 and a missing mean.
    """
    moments = earlier_moments(df, key, time, amount, label, spread_by, slice_seconds, rows_per_task)
    stats = moment_statistics(*[F.col(m) for m in MOMENTS], prefix)
    return moments.select(*df.columns, *[c.alias(n) for n, c in stats.items()])


def fit_statistics(train: DataFrame, groups: tuple[Grouping, ...] = GROUPINGS) -> GroupTables:
    """Stored statistics of all groupings, learned on ``train``."""
    return aggregate_groupings(train, groups)


def apply_statistics(
    df: DataFrame,
    fitted: GroupTables,
    defaults: dict[str, float],
    spread_by: list[str] | None = None,
    **limits: int,
) -> DataFrame:
    """Join fitted statistics; keys the training table never saw get the defaults."""
    columns = [f"{g.prefix}_{m}" for g in fitted.groups for m in g.joined]
    joined = join_groupings(df, fitted, spread_by, **limits)
    return joined.withColumns({c: F.coalesce(F.col(c), F.lit(float(defaults[c]))) for c in columns})
