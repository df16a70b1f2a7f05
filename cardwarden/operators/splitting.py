"""Splits, samples and folds with exact class quotas.

Membership is decided by a digest of the row key (see ``functions.hashing``). For an exact quota
the digest at the quota's rank is looked up first, reading only key and label; afterwards every row
is placed by comparing its own digest with a handful of constants, without moving any row.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cardwarden.functions.hashing import digest, uniform
from cardwarden.schema import LABEL, SPLIT_DEFAULTS
from cardwarden.session import setting

#: A digest range is narrowed by four hex digits at a time until it holds at most this many rows;
#: only time depends on it. Setting ``digestRange``.
_SMALL_RANGE = 100_000


@dataclass(frozen=True)
class Cuts:
    """For every stratum the parts in digest order, each with its last digest (None: the rest)."""

    key: tuple[str, ...]
    seed: int
    stratum: str | None
    parts: dict[object, list[tuple[object, str | None]]]

    def assign(self, df: DataFrame, column: str) -> DataFrame:
        """Append the part each row belongs to; the digest is computed once per row."""
        h = F.col("_digest")
        placed = F.lit(None)
        for value, parts in self.parts.items():
            part = F.lit(None)
            for name, last in reversed(parts):
                part = F.lit(name) if last is None else F.when(h <= last, F.lit(name)).otherwise(part)
            if self.stratum is None:
                placed = part
            else:
                placed = F.when(F.col(self.stratum) == F.lit(value), part).otherwise(placed)
        return (
            df.withColumn("_digest", digest(list(self.key), self.seed))
            .withColumn(column, placed)
            .drop("_digest")
        )


#: Strata whose counts reach the driver and whose cuts become constants of a plan.
MAX_STRATA = 1000


def stratum_counts(df: DataFrame, stratum: str | None, complete: bool = False) -> dict[object, int]:
    """Rows per stratum, at most ``MAX_STRATA``; rows without one are left out, or an error if ``complete``."""
    if stratum is None:
        return {None: df.count()}
    rows = df.groupBy(stratum).count().orderBy(stratum).limit(MAX_STRATA + 2).collect()
    if complete and any(r[0] is None for r in rows):
        raise ValueError(f"rows without {stratum} belong to no split")
    counts = {r[0]: r["count"] for r in rows if r[0] is not None}
    if len(counts) > MAX_STRATA:
        raise ValueError(f"{stratum} has more than {MAX_STRATA} values; it is no label")
    return counts


def digests_at_ranks(
    df: DataFrame, key: list[str], stratum: str | None, ranks: dict[object, list[int]], seed: int
) -> dict[tuple[object, int], str]:
    """The digest of the n-th row (one-based) in digest order, per stratum and wanted rank.

    Four hex digits at a time, a histogram of the current digest range (65,536 counts per stratum
    and rank at most) locates the next smaller range holding the rank. Only the rows of a small
    range are finally put in order.
    """
    spark = df.sparkSession
    small = setting(spark, "digestRange", _SMALL_RANGE)
    h = digest(key, seed)
    group = F.lit(0) if stratum is None else F.col(stratum)
    rows = df.select(group.alias("s"), h.alias("h"))
    if stratum is not None:
        rows = rows.where(F.col("s").isNotNull())
    wanted = [(s, r, r, "") for s, rs in ranks.items() for r in rs]
    if not wanted:
        return {}

    def targets(items: list[tuple]) -> DataFrame:
        data = [(0 if stratum is None else s, rank, left, prefix) for s, rank, left, prefix in items]
        stype = "long" if stratum is None else rows.schema["s"].dataType.simpleString()
        plain = spark.createDataFrame(data, f"s {stype}, rank long, rest long, prefix string")
        return F.broadcast(plain)

    digits = 0
    narrowed = wanted
    while digits < 32:
        goal = targets(narrowed)
        following = F.substring("h", 1, digits + 4).alias("next")
        if digits == 0:
            counted = rows.groupBy("s", following).agg(F.count(F.lit(1)).alias("n"))
            histogram = counted.join(goal.drop("prefix"), "s")
        else:
            ranged = rows.withColumn("prefix", F.substring("h", 1, digits)).join(goal, ["s", "prefix"])
            histogram = ranged.groupBy("s", "rank", "rest", following).agg(
                F.count(F.lit(1)).alias("n")
            )
        upto = Window.partitionBy("s", "rank").orderBy("next").rowsBetween(Window.unboundedPreceding, -1)
        found = (
            histogram.withColumn("before", F.coalesce(F.sum("n").over(upto), F.lit(0)))
            .where((F.col("rest") > F.col("before")) & (F.col("rest") <= F.col("before") + F.col("n")))
            .collect()  # one row per stratum and rank
        )
        narrowed = [
            (None if stratum is None else r["s"], r["rank"], r["rest"] - r["before"], r["next"]) for r in found
        ]
        digits += 4
        if all(r["n"] <= small for r in found):
            break
    goal = targets(narrowed)
    order = Window.partitionBy("s", "rank").orderBy("h")
    hits = (
        rows.withColumn("prefix", F.substring("h", 1, digits))
        .join(goal, ["s", "prefix"])
        .withColumn("rn", F.row_number().over(order))
        .where(F.col("rn") == F.col("rest"))
        .collect()
    )
    return {(None if stratum is None else r["s"], r["rank"]): r["h"] for r in hits}


def cut_by_quota(
    df: DataFrame,
    key: list[str],
    stratum: str | None,
    quotas: dict[object, list[tuple[object, int | None]]],
    seed: int,
) -> Cuts:
    """Turn per-stratum quotas ``[(part, rows), ..., (rest, None)]`` into digest cuts."""
    ranks: dict[object, list[int]] = {}
    ends: dict[object, list[tuple[object, int | None]]] = {}
    for s, parts in quotas.items():
        total, ends[s] = 0, []
        for name, n in parts:
            if n is None:
                ends[s].append((name, None))
            elif n > 0:
                total += n
                ends[s].append((name, total))
        ranks[s] = sorted({e for _, e in ends[s] if e is not None})
    found = digests_at_ranks(df, key, stratum, ranks, seed)
    parts = {
        s: [(name, None if end is None else found[(s, end)]) for name, end in items]
        for s, items in ends.items()
    }
    return Cuts(tuple(key), seed, stratum, parts)


def proportional_shares(counts: dict[object, int], wanted: int) -> dict[object, int]:
    """Distribute ``wanted`` rows over the classes in proportion, by largest remainder.

    Equal remainders go to the larger class, then to the smaller label.
    """
    total = sum(counts.values())
    exact = {c: n * wanted / total for c, n in counts.items()}
    share = {c: math.floor(x) for c, x in exact.items()}
    order = sorted(counts, key=lambda c: (-(exact[c] - share[c]), -counts[c], str(c)))
    for c in order[: wanted - sum(share.values())]:
        share[c] += 1
    return share


def split_sizes(rows: int, test_size: float, val_size: float) -> tuple[int, int, int]:
    """Train, validation and test rows: both draws round up, the rest is train."""
    n_test = math.ceil(rows * test_size)
    n_val = math.ceil((rows - n_test) * (val_size / (1 - test_size)))
    return rows - n_test - n_val, n_val, n_test


def fit_split(
    df: DataFrame,
    key: list[str],
    label: str = LABEL,
    test_size: float = SPLIT_DEFAULTS["test_size"],
    val_size: float = SPLIT_DEFAULTS["val_size"],
    seed: int = SPLIT_DEFAULTS["seed"],
    stratify: bool = True,
) -> Cuts:
    """Exact train/validation/test cuts. ``key`` must identify a row; a row without a label is an error.

    ``df`` should be the raw table: only key and label are read.
    """
    stratum = label if stratify else None
    counts = stratum_counts(df, stratum, complete=True)
    n_train, n_val, n_test = split_sizes(sum(counts.values()), test_size, val_size)
    kept = proportional_shares(counts, n_train + n_val)
    test = {c: n - kept[c] for c, n in counts.items()}
    train = proportional_shares(kept, n_train) if n_train + n_val else dict.fromkeys(kept, 0)
    quotas = {
        c: [("test", test[c]), ("val", kept[c] - train[c]), ("train", None)] for c in counts
    }
    return cut_by_quota(df, key, stratum, quotas, seed)


def with_split(df: DataFrame, cuts: Cuts) -> DataFrame:
    return cuts.assign(df, "split")


def hash_split(
    df: DataFrame,
    key: list[str],
    test_size: float = SPLIT_DEFAULTS["test_size"],
    val_size: float = SPLIT_DEFAULTS["val_size"],
    seed: int = SPLIT_DEFAULTS["seed"],
) -> DataFrame:
    """Approximate sizes, no look-up pass: the draw itself decides the split."""
    u = uniform(key, seed)
    return df.withColumn(
        "split",
        F.when(u < test_size, F.lit("test"))
        .when(u < test_size + val_size, F.lit("val"))
        .otherwise(F.lit("train")),
    )


def stratified_sample(
    df: DataFrame,
    key: list[str],
    fraction: float = 0.5,
    label: str = LABEL,
    seed: int = SPLIT_DEFAULTS["seed"],
) -> DataFrame:
    """``round(fraction * n)`` rows of every class, without replacement."""
    counts = stratum_counts(df, label)
    quotas = {c: [(True, round(fraction * n)), (False, None)] for c, n in counts.items()}
    cuts = cut_by_quota(df, key, label, quotas, seed)
    return cuts.assign(df, "_drawn").where("_drawn").drop("_drawn")


def with_folds(
    df: DataFrame,
    key: list[str],
    folds: int,
    label: str = LABEL,
    seed: int = SPLIT_DEFAULTS["seed"],
    column: str = "fold",
) -> DataFrame:
    """Fold numbers 0..folds-1; class counts differ by at most one row between folds.

    Classes continue where the previous class stopped dealing, so fold totals stay level as well.
    """
    quotas, start = {}, 0
    for c, n in stratum_counts(df, label).items():
        sizes = [(start + n - 1 - i) // folds - (start - 1 - i) // folds for i in range(folds)]
        quotas[c] = [(i, size) for i, size in enumerate(sizes)]
        start += n
    cuts = cut_by_quota(df, key, label, quotas, seed)
    return cuts.assign(df, column).withColumn(column, F.col(column).cast("int"))
