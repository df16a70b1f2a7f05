"""Per-card, per-merchant and per-category statistics."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardwarden.operators.keyed_join import attach, attach_shuffled, broadcast_limit
from cardwarden.schema import LABEL
from cardwarden.session import settle


@dataclass(frozen=True)
class Grouping:
    """A key column and the measures that are joined back for it, in output order."""

    key: str
    prefix: str
    joined: tuple[str, ...]


CARD = Grouping("cc_num", "customer", ("txn_count", "avg_amt", "std_amt", "fraud_rate"))
MERCHANT = Grouping("merchant", "merchant", ("fraud_rate", "txn_count", "avg_amt", "std_amt"))
CATEGORY = Grouping("category", "category", ("fraud_rate", "txn_count", "avg_amt"))
GROUPINGS = (CARD, MERCHANT, CATEGORY)


def _measures(amount: str, label: str) -> dict[str, Column]:
    return {
        "txn_count": F.count(F.lit(1)),
        "avg_amt": F.avg(amount),
        "std_amt": F.coalesce(F.stddev_samp(amount), F.lit(0.0)),
        "total_amt": F.sum(amount),
        "fraud_count": F.sum(F.col(label).cast("bigint")),
        "fraud_rate": F.coalesce(F.avg(label), F.lit(0.0)),
    }


def group_statistics(
    df: DataFrame,
    group: Grouping,
    measures: tuple[str, ...] | None = None,
    amount: str = "amt",
    label: str = LABEL,
) -> DataFrame:
    """One row per key with ``<prefix>_<measure>`` columns; rows without a key take no part.

    Every measure combines on the map side, so a hot key costs one partial row per task.
    """
    chosen = measures or group.joined
    available = _measures(amount, label)
    return (
        df.where(F.col(group.key).isNotNull())
        .groupBy(group.key)
        .agg(*[available[m].alias(f"{group.prefix}_{m}") for m in chosen])
    )


def customer_statistics(df: DataFrame) -> DataFrame:
    return group_statistics(
        df, CARD, ("txn_count", "avg_amt", "std_amt", "total_amt", "fraud_count", "fraud_rate")
    )


def merchant_statistics(df: DataFrame) -> DataFrame:
    return group_statistics(
        df, MERCHANT, ("txn_count", "avg_amt", "std_amt", "fraud_count", "fraud_rate")
    )


def category_statistics(df: DataFrame) -> DataFrame:
    return group_statistics(df, CATEGORY, ("txn_count", "avg_amt", "fraud_count", "fraud_rate"))


def join_statistics(
    df: DataFrame,
    group: Grouping,
    stats: DataFrame | None = None,
    spread_by: list[str] | None = None,
    **limits: int,
) -> DataFrame:
    """Append the statistics of one grouping to every transaction."""
    stats = group_statistics(df, group) if stats is None else stats
    columns = [f"{group.prefix}_{m}" for m in group.joined]
    joined = attach(
        df, stats, [group.key], f"{group.prefix}_txn_count", spread_by or ["trans_num"], **limits
    )
    return joined.select(*df.columns, *columns)


@dataclass(frozen=True)
class GroupTables:
    """Stored statistics of several groupings: rows ``(grouping, key, measures)`` and their sizes."""

    table: DataFrame
    sizes: dict[str, int]
    groups: tuple[Grouping, ...]

    def of(self, group: Grouping) -> DataFrame:
        return self.table.where(F.col("grouping") == group.key).select(
            F.col("key").alias(group.key),
            *[F.col(m).alias(f"{group.prefix}_{m}") for m in group.joined],
        )


#: Category takes no standard deviation; computing it along costs nothing extra.
_ALL_MEASURES = ["txn_count", "avg_amt", "std_amt", "fraud_rate"]


def aggregate_groupings(
    df: DataFrame,
    groups: tuple[Grouping, ...] = GROUPINGS,
    amount: str = "amt",
    label: str = LABEL,
) -> GroupTables:
    """Statistics of several groupings from one narrow scan.

    The keys are unpivoted to ``(grouping, key)`` before one partial-plus-final aggregation. The
    result is stored, which gives its exact size per grouping.
    """
    available = _measures("amount", "label")
    long = (
        df.select(
            F.col(amount).alias("amount"),
            F.col(label).alias("label"),
            *[F.col(g.key) for g in groups],
        )
        .unpivot(["amount", "label"], [g.key for g in groups], "grouping", "key")
        .where(F.col("key").isNotNull())
    )
    table = settle(
        long.groupBy("grouping", "key").agg(*[available[m].alias(m) for m in _ALL_MEASURES])
    )
    sizes = {
        r["grouping"]: r["rows"] * (48 + 24 + 8 * len(_ALL_MEASURES)) + r["text"]
        for r in table.groupBy("grouping")
        .agg(F.count(F.lit(1)).alias("rows"), F.sum(F.octet_length("key")).alias("text"))
        .collect()  # one row per grouping
    }
    return GroupTables(table, sizes, groups)


def join_groupings(
    df: DataFrame,
    tables: GroupTables,
    spread_by: list[str] | None = None,
    broadcast_bytes: int | None = None,
    rows_per_task: int | None = None,
    same_rows: bool = False,
) -> DataFrame:
    """Append stored statistics to every transaction.

    Groupings up to ``broadcast_bytes`` are broadcast. For larger ones hot keys are found by the
    row counts of the statistics if they describe ``df`` itself (``same_rows``), else by counting
    the keys of ``df``, because a key may be hot here without being known there.
    """
    joined, columns = df, list(df.columns)
    limit = broadcast_limit(df.sparkSession, broadcast_bytes)
    for g in tables.groups:
        stats = tables.of(g)
        if tables.sizes.get(g.key, 0) <= limit:
            joined = joined.join(F.broadcast(stats), g.key, "left")
        else:
            counted = {}
            rows_column = f"{g.prefix}_txn_count"
            if not same_rows:
                rows_column = "_rows"
                counts = df.where(F.col(g.key).isNotNull()).groupBy(g.key)
                counted = {
                    "counts": counts.agg(F.count(F.lit(1)).alias(rows_column)),
                    "counted_by": [g.key],
                }
            joined = attach_shuffled(
                joined, stats, [g.key], rows_column, spread_by or ["trans_num"], rows_per_task, **counted
            )
        columns += [f"{g.prefix}_{m}" for m in g.joined]
    return joined.select(*columns)


def join_all_statistics(
    df: DataFrame,
    groups: tuple[Grouping, ...] = GROUPINGS,
    spread_by: list[str] | None = None,
    broadcast_bytes: int | None = None,
    rows_per_task: int | None = None,
) -> DataFrame:
    """Append the statistics that ``df`` has about itself: one scan to aggregate, one to join."""
    tables = aggregate_groupings(df, groups)
    return join_groupings(df, tables, spread_by, broadcast_bytes, rows_per_task, same_rows=True)
