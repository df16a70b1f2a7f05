"""Joining per-key statistics back to transactions.

Statistics have one row per key, but the number of keys grows with the data, and one key may own a
large share of the transactions. So the size is measured before anything is broadcast, and the
shuffled form splits hot keys by the row counts that the statistics already carry.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardwarden.session import setting, settle

#: Statistics up to this size are shipped to every executor. Setting ``broadcastBytes``.
BROADCAST_BYTES = 64 * 1024 * 1024
#: Keys with more rows than this are spread over several join tasks. Setting ``rowsPerTask``.
ROWS_PER_TASK = 2_000_000


def broadcast_limit(spark: SparkSession, given: int | None = None) -> int:
    return setting(spark, "broadcastBytes", BROADCAST_BYTES) if given is None else given


def measured_bytes(stats: DataFrame) -> int:
    """Size of a settled table as it would sit in a broadcast hash map."""
    text = [f.name for f in stats.schema.fields if isinstance(f.dataType, T.StringType)]
    fixed = 48 + 8 * (len(stats.columns) - len(text))
    row = stats.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.sum(F.octet_length(c)).alias(c) for c in text],
    ).first()
    return row["rows"] * (fixed + 24 * len(text)) + sum(row[c] or 0 for c in text)


def attach(
    df: DataFrame,
    stats: DataFrame,
    keys: list[str],
    rows_column: str,
    spread_by: list[str],
    broadcast_bytes: int | None = None,
    rows_per_task: int | None = None,
) -> DataFrame:
    """Left join of ``stats`` (one row per key) on ``keys``; rows without a key keep NULLs.

    ``rows_column`` names the number of transactions behind each key and is left out of the result
    if ``df`` should not see it (prefix ``_``). ``spread_by`` are columns that vary inside a key.
    """
    stats = settle(stats)
    if measured_bytes(stats) <= broadcast_limit(df.sparkSession, broadcast_bytes):
        joined = df.join(F.broadcast(stats), keys, "left")
    else:
        joined = attach_shuffled(df, stats, keys, rows_column, spread_by, rows_per_task)
    return joined.drop(rows_column) if rows_column.startswith("_") else joined


def attach_shuffled(
    df: DataFrame,
    stats: DataFrame,
    keys: list[str],
    rows_column: str,
    spread_by: list[str],
    rows_per_task: int | None = None,
    counts: DataFrame | None = None,
    counted_by: list[str] | None = None,
) -> DataFrame:
    """The same left join without a broadcast of the statistics.

    A group with ``c`` rows is split into ``ceil(c / rows_per_task)`` slices. At most
    ``rows / rows_per_task`` groups can have more than one slice. Their list is measured; beyond
    ``BROADCAST_BYTES`` (over a million hot groups) it is joined as Spark sees fit, with its skew joins.
    The statistics of a hot group are repeated once per slice. The groups are the keys
    themselves unless ``counts`` gives row counts (``rows_column``) for coarser ``counted_by``
    columns, which both ``df`` and ``stats`` then have to carry.
    """
    counts, counted_by = (stats, keys) if counts is None else (counts, counted_by)
    rows_per_task = rows_per_task or setting(df.sparkSession, "rowsPerTask", ROWS_PER_TASK)
    slices = F.ceil(F.col(rows_column) / F.lit(rows_per_task)).cast("int")
    hot = counts.where(F.col(rows_column) > rows_per_task).select(*counted_by, slices.alias("_slices"))
    hot = settle(hot)
    if measured_bytes(hot) <= BROADCAST_BYTES:
        hot = F.broadcast(hot)
    if counts is stats:
        parts = F.greatest(slices, F.lit(1))
        repeated = stats
    else:
        parts = F.coalesce("_slices", F.lit(1))
        repeated = stats.join(hot, counted_by, "left")
    sliced = repeated.withColumn("_slice", F.explode(F.sequence(F.lit(0), parts - 1)))
    sliced = sliced.drop("_slices", *[c for c in counted_by if c not in keys])
    spread = F.xxhash64(*spread_by)
    no_key = reduce(Column.__or__, [F.col(k).isNull() for k in keys])
    # Rows without a key match nothing; the draw only keeps them from meeting in one task.
    slice_of_row = (
        F.when(no_key, F.pmod(spread, F.lit(1 << 20)))
        .when(F.col("_slices").isNotNull(), F.pmod(spread, F.col("_slices")))
        .otherwise(F.lit(0))
        .cast("int")
    )
    marked = df.join(hot, counted_by, "left").withColumn("_slice", slice_of_row)
    return marked.drop("_slices").join(sliced, [*keys, "_slice"], "left").drop("_slice")
