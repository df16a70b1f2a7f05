"""Hard negatives of anchors: rows of other labels whose scores lie in a window set by each of the anchor's positives.

An anchor's windows overlap: each reaches from a share of its positive's score down to a smaller share. The positives'
upper limits cut the scores into disjoint slots. Rows are dealt to groups and anchors, a stated query set, go to every
group in blocks; a task keeps the first ``negatives`` rows of each slot, and so does the combination of all groups,
so an anchor never has more than ``positives * negatives`` candidates. As slots are disjoint and descending, the
first rows at or below a limit are a suffix of the slots, merged in order; those under the window's lower limit go.

Rows without id, label or vector, and vectors that are empty or have missing or non-finite components (also after
scaling), take no part. Each row of a repeated id is a row of its own, an anchor too; ties go to the smaller id, then
to any. Only vectors of equal length meet. Positives below zero have no window. An empty table, or one of a single
label, gives an empty table. Scores are exact; one beyond a long is an error. Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cardwarden.llm.vectors import exact_products, matrix, quantised
from cardwarden.session import settle_table

#: Rows of a group, of a block in it, and anchors compared at a time.
GROUP, BLOCK, ANCHORS = 65_536, 4_096, 256


class Residents:
    """The rows of a group with one form of vector, by label."""

    def __init__(self, rows: list[tuple[np.ndarray, ...]]):
        row, ids, labels, q = (np.concatenate(x) for x in zip(*rows))
        order = np.argsort(labels, kind="stable")
        self.row, self.ids, self.labels, self.q = row[order], ids[order], labels[order], q[order]

    def of_label(self, label: int) -> slice:
        return slice(*np.searchsorted(self.labels, [label, label + 1]))


def first_k(keys: list[np.ndarray], score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores under each combination of keys, ties to the smaller id."""
    order = np.lexsort((ids, -score, *reversed(keys)))
    new = np.zeros(len(order), bool)
    new[:1] = True
    for key in keys:
        new[1:] |= key[order][1:] != key[order][:-1]
    begin = np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))
    return order[np.arange(len(order)) - begin < k]


def positives_in(own: Residents, row: np.ndarray, label: np.ndarray, q: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """(anchor, id, row, score) of the k best rows of the anchors' labels, the anchor itself left out."""
    found: list[tuple[np.ndarray, ...]] = []
    for value in np.unique(label):
        some, there = np.flatnonzero(label == value), own.of_label(value)
        best: tuple[np.ndarray, ...] = tuple(np.zeros(0, np.int64) for _ in range(4))
        for at in range(there.start, there.stop, BLOCK):
            block = slice(at, min(at + BLOCK, there.stop))
            scores = exact_products(q[some], own.q[block])
            i, j = np.nonzero(row[some][:, None] != own.row[None, block])
            new = (some[i], own.ids[block][j], own.row[block][j], scores[i, j])
            best = tuple(np.concatenate(x) for x in zip(best, new))
            keep = first_k([best[0]], best[3], best[1], k)
            best = tuple(x[keep] for x in best)
        found.append(best)
    return tuple(np.concatenate(x) for x in zip(*found))


def slots_in(own: Residents, label: np.ndarray, q: np.ndarray, upper: np.ndarray, lower: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """(anchor, slot, id, row, score) of the k best rows of other labels in each slot. ``upper``: descending limits, the
    places behind the last one repeat it; ``lower``: the anchors' least limit."""
    best: tuple[np.ndarray, ...] = tuple(np.zeros(0, np.int64) for _ in range(5))
    for at in range(0, len(own.row), BLOCK):
        block = slice(at, at + BLOCK)
        scores = exact_products(q, own.q[block])
        inside = (scores <= upper[:, :1]) & (scores >= lower[:, None]) & (label[:, None] != own.labels[None, block])
        i, j = np.nonzero(inside)
        score = scores[i, j]
        slot = (score[:, None] <= upper[i]).sum(1)
        new = (i, slot, own.ids[block][j], own.row[block][j], score)
        best = tuple(np.concatenate(x) for x in zip(best, new))
        keep = first_k([best[0], best[1]], best[4], best[2], k)
        best = tuple(x[keep] for x in best)
    return best


def _searching(
    find: Callable[[Residents, np.ndarray, np.ndarray, pa.RecordBatch, np.ndarray], tuple[np.ndarray, ...]], names: list[str]
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Tasks get rows by group, in it residents (role 0) before anchors (role 1), both by form of vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, rows, ready, codes = None, {}, {}, {}
        for batch in batches:
            part = np.stack([batch.column(c).to_numpy() for c in ("part", "role", "n", "width")])
            cuts = np.flatnonzero(np.diff(part, axis=1).any(0)) + 1
            for at, to in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
                if at == to:
                    continue
                place, role, n, width = part[:, at].tolist()
                if place != group:
                    group, rows, ready, codes = place, {}, {}, {}
                some = batch.slice(at, to - at)
                q = matrix(some.column("q"), n, width)
                label = np.fromiter((codes.setdefault(x, len(codes)) for x in some.column("label").to_pylist()), np.int64, len(q))
                row = some.column("row").to_numpy()
                if role == 0:
                    rows.setdefault((n, width), []).append((row, some.column("id").to_numpy(), label, q))
                    continue
                for form, own in rows.items():
                    if form[0] != n:
                        continue
                    if form not in ready:
                        ready[form] = Residents(own)
                    for a in range(0, len(q), ANCHORS):
                        piece = slice(a, a + ANCHORS)
                        anchor, *out = find(ready[form], row[piece], label[piece], some.slice(a, ANCHORS), q[piece])
                        yield pa.RecordBatch.from_arrays([pa.array(row[piece][anchor]), *map(pa.array, out)], names)

    return run


def _dealt(residents: DataFrame, asked: DataFrame, groups: int) -> DataFrame:
    """All rows once and each anchor in every group."""
    own = residents.select(F.pmod(F.xxhash64("row"), F.lit(groups)).cast("int").alias("part"), F.lit(0).cast("byte").alias("role"), "*")
    everywhere = F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))
    ask = asked.select(everywhere.alias("part"), F.lit(1).cast("byte").alias("role"), "*")
    return own.unionByName(ask, allowMissingColumns=True).repartition(groups, "part").sortWithinPartitions("part", "role", "n", "width")


def limits(score: str, low: int, high: int) -> tuple[F.Column, F.Column]:
    """Lowest and highest integer of a window from low to high hundredths of a score, without overflow."""
    hundreds, rest = f"(({score} - pmod({score}, 100)) div 100)", f"pmod({score}, 100)"
    return (
        F.expr(f"{hundreds} * {low} + CAST(ceil({rest} * {low} / 100) AS BIGINT)"),
        F.expr(f"{hundreds} * {high} + CAST(floor({rest} * {high} / 100) AS BIGINT)"),
    )


def mine(
    vectors: DataFrame, anchors: str, label: str = "label", positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95,
    scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding", group_rows: int = GROUP,
) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``.

    ``anchors``: SQL condition on ``id``; ``label``: SQL expression over the input's columns. Components are floored
    after scaling; a negative's score lies between ``low`` and ``high`` hundredths of its positive's.
    """
    spark = vectors.sparkSession
    valid = quantised(vectors, id_col, vector_col, scale, f"CAST({label} AS string) AS label")
    valid = valid.where("id IS NOT NULL AND label IS NOT NULL").withColumn("row", F.monotonically_increasing_id())
    table = settle_table(valid.select("row", "id", "label", "n", "width", "q"), "vectors")
    groups = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-table.count() // group_rows))
    asked = table.where(anchors)

    def best_own(own: Residents, row: np.ndarray, label: np.ndarray, _, q: np.ndarray) -> tuple[np.ndarray, ...]:
        return positives_in(own, row, label, q, positives)

    found = _dealt(table, asked, groups).mapInArrow(
        _searching(best_own, ["anchor", "id", "row", "score"]), "anchor bigint, id bigint, row bigint, score bigint"
    )
    order = Window.partitionBy("anchor").orderBy(F.desc("score"), "id", "row")
    lower, upper = limits("score", low, high)
    chosen = found.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= positives)
    chosen = settle_table(
        chosen.select("anchor", "nth", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"),
                      lower.alias("lower"), upper.alias("upper")),
        "positives",
    )

    # At most ``positives`` entries an anchor. A window that no score can lie in doesn't widen the search.
    windows = chosen.groupBy("anchor").agg(
        F.sort_array(F.collect_list("upper"), asc=False).alias("upper"),
        F.min(F.when(F.col("lower") <= F.col("upper"), F.col("lower"))).alias("lower"),
    ).where("lower IS NOT NULL")

    def best_others(own: Residents, row: np.ndarray, label: np.ndarray, some: pa.RecordBatch, q: np.ndarray) -> tuple[np.ndarray, ...]:
        lists = some.column("upper").to_pylist()
        upper = np.array([x + [x[-1]] * (positives - len(x)) for x in lists], np.int64).reshape(-1, positives)
        anchor, slot, *rest = slots_in(own, label, q, upper, some.column("lower").to_numpy(), negatives)
        # Repeated limits at the end are no slots of their own.
        slot = np.minimum(slot, np.array(list(map(len, lists)), np.int64)[anchor])
        return anchor, slot, *rest

    narrowed = asked.join(windows.withColumnRenamed("anchor", "row"), "row")
    slots = _dealt(table, narrowed, groups).mapInArrow(
        _searching(best_others, ["anchor", "slot", "id", "row", "score"]),
        "anchor bigint, slot bigint, id bigint, row bigint, score bigint",
    )
    order = Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), "id", "row")
    slots = slots.withColumn("place", F.row_number().over(order)).where(F.col("place") <= negatives)
    # Slots descend, so their rows one after the other are in the order of scores: at most positives * negatives.
    merged = slots.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("slot", "place", "id", "score"))).alias("found"))
    suffix = F.slice(F.filter("found", lambda x: x["slot"] >= F.col("nth")), 1, negatives)
    inside = F.filter(suffix, lambda x: x["score"] >= F.col("lower"))
    ids = table.where(anchors).select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id"))
    answers = chosen.join(merged, "anchor").join(ids, "anchor")
    answers = answers.select("anchor_id", "positive_id", "positive_score", F.posexplode(inside).alias("at", "x"))
    return answers.select(
        "anchor_id", "positive_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("x.id").alias("negative_id"),
        "positive_score", F.col("x.score").alias("negative_score"),
    )
