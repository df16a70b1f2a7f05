"""Exact top-k search by inner product over norm-sorted vectors.

Vectors are quantised to integers and rotated by the right singular vectors of a bounded sample (its
``fit_rows`` longest vectors), so that the first components hold most of the length. Those longest vectors, known to
every task, give each query a score that its k-th best reaches in any case. All vectors are dealt to groups by
descending length, and a query goes only to the groups whose longest vector can still reach that score. In a group
the vectors lie longest first and the queries stream past them: a whole block is skipped when the product of
lengths cannot reach the query's k-th best score; else the partial sums over the first components plus the
Cauchy-Schwarz bound of the rest leave few pairs, and those get their exact integer product.

Vectors that are missing, empty, or have missing or non-finite components take no part, nor do rows without id.
Components may have any size; a score beyond 64 bits is an error. Every row counts: rows that share an id are
candidates and queries of their own, and a query meets all rows but itself. Only vectors of equal length of list
meet. Ties go to the smaller id. An empty table gives an empty table. Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cardwarden.llm.vectors import exact_products, matrix, quantised
from cardwarden.session import settle_table

#: Residents of a group, and of a block in it.
GROUP = 32_768
BLOCK = 2_048
#: Ranges of lengths; a range of many vectors has several groups.
RANGES = 1_024


def components_of(column: pa.Array, n: int, widths: np.ndarray) -> np.ndarray:
    """Rows of ``n`` integer components: 32 bits where they suffice, else doubles, which hold all of them exactly."""
    out = np.zeros((len(widths), n), np.int32 if widths.max(initial=0) <= 4 else np.float64)
    for width in np.unique(widths):
        some = np.flatnonzero(widths == width)
        out[some] = matrix(column.take(pa.array(some)), n, int(width))
    return out


def lengths(x: np.ndarray) -> np.ndarray:
    """Euclidean length of each row, scaled by its largest component meanwhile."""
    most = np.maximum(np.abs(x).max(1, initial=0.0), 1.0)
    return np.sqrt(np.square(x / most[:, None]).sum(1)) * most


def row_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The exact inner product of each row of ``a`` with the same row of ``b``."""
    if not len(a):
        return np.zeros(0, np.int64)
    if float(np.abs(a).max()) * float(np.abs(b).max()) * a.shape[1] < 2.0**62:
        return np.einsum("ij,ij->i", a.astype(np.int64), b.astype(np.int64))
    return np.concatenate([exact_products(x[None], y[None])[0] for x, y in zip(a, b)])


class Index:
    """The vectors of one group and one length of list, longest first, in rotated coordinates."""

    def __init__(self, places: np.ndarray, ids: np.ndarray, q: np.ndarray, basis: np.ndarray, head: int):
        norms = lengths(q.astype(np.float64))
        order = np.argsort(-norms, kind="stable")
        self.places, self.ids, self.q, self.norms = places[order], ids[order], q[order], norms[order]
        rotated = self.q.astype(np.float64) @ basis
        self.first, self.basis, self.head = rotated[:, :head], basis, head
        self.rest = lengths(rotated[:, head:])

    def search(self, places: np.ndarray, q: np.ndarray, floor: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
        """(query row, id, score) of all that may be among the k best of a query; ``floor``: a score that its
        k-th best reaches in any case."""
        norms = lengths(q.astype(np.float64))
        rotated = q.astype(np.float64) @ self.basis
        first, rest = rotated[:, : self.head], lengths(rotated[:, self.head :])
        floor = floor.astype(np.float64).copy()
        found: list[tuple[np.ndarray, ...]] = []
        for at in range(0, len(self.ids), BLOCK):
            block = slice(at, at + BLOCK)
            # Lengths and sums are rounded; the slack keeps the bounds on the safe side.
            slack = 1.0 + 1e-9 * norms * self.norms[at]
            open_ = np.flatnonzero(~(norms * self.norms[at] + slack < floor))
            if not len(open_):
                break
            bound = first[open_] @ self.first[block].T + np.outer(rest[open_], self.rest[block]) + slack[open_, None]
            i, j = np.nonzero(~(bound < floor[open_, None]) & (places[open_, None] != self.places[None, block]))
            if len(i) * 8 > bound.size:
                scores = exact_products(q[open_], self.q[block])[i, j]
            else:
                parts = len(i) // 100_000 + 1
                pairs = zip(np.array_split(i, parts), np.array_split(j, parts))
                scores = np.concatenate([row_products(q[open_[a]], self.q[at + b]) for a, b in pairs])
            row = open_[i]
            keep = scores >= floor[row]
            row, vec, scores = row[keep], self.ids[at + j[keep]], scores[keep]
            found.append((row, vec, scores))
            row, vec, scores = (np.concatenate(x) for x in zip(*found))
            row, vec, scores = best(row, vec, scores, k)
            found = [(row, vec, scores)]
            full = np.bincount(row, minlength=len(q)) >= k
            lowest = np.full(len(q), np.iinfo(np.int64).max)
            np.minimum.at(lowest, row, scores)
            floor[full] = np.maximum(floor[full], lowest[full])
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        return found[0]


def best(row: np.ndarray, vec: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """The k highest scores of each row, ties to the smaller id."""
    order = np.lexsort((vec, -scores, row))
    row, vec, scores = row[order], vec[order], scores[order]
    nth = np.arange(len(row)) - np.searchsorted(row, row, side="left")
    return row[nth < k], vec[nth < k], scores[nth < k]


def top_k(
    vectors: DataFrame, queries: str, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding",
    fit_rows: int = 4096, group_rows: int = GROUP,
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``. ``queries``: SQL condition on ``id`` that chooses the queries."""
    spark = vectors.sparkSession
    rows = quantised(vectors, id_col, vector_col, 1024).where("id IS NOT NULL")
    table = settle_table(rows.withColumn("place", F.monotonically_increasing_id()), "vectors")
    longest = table.orderBy(F.desc("norm"), "id", "place").limit(fit_rows).toArrow()  # at most fit_rows rows
    heads: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = {}
    sizes = longest.column("n").to_numpy()
    for n in map(int, np.unique(sizes)):
        some = longest.filter(pa.array(sizes == n)).combine_chunks()
        q = components_of(some.column("q").combine_chunks(), n, some.column("width").to_numpy())
        basis = np.linalg.svd(q / np.maximum(1.0, np.abs(q).max()), full_matrices=True)[2].T
        heads[n] = some.column("place").to_numpy(), some.column("id").to_numpy(), q, basis
    # Ranges of lengths, longest first; each has as many groups as its vectors fill.
    ranges = min(RANGES, -(-table.count() // group_rows))
    shares = [i / ranges for i in range(1, ranges)]
    borders = np.unique(table.approxQuantile("norm", shares, 0.1 / ranges) if shares else [])

    def range_of(norm: pa.Array) -> pa.Array:
        return pa.array((len(borders) - np.searchsorted(borders, norm.to_numpy(), side="right")).astype(np.int32))

    placed = table.withColumn("range", F.arrow_udf(range_of, "int")("norm"))
    counts = placed.groupBy("range").agg(F.count("*").alias("rows"), F.max("norm").alias("top")).orderBy("range").collect()
    groups_of = {r["range"]: -(-r["rows"] // group_rows) for r in counts}  # at most RANGES entries
    before = np.concatenate([[0], np.cumsum(list(groups_of.values()))]).astype(np.int64)
    groups = max(1, int(before[-1]))
    tops = np.repeat([r["top"] for r in counts], list(groups_of.values()))
    shared = spark.sparkContext.broadcast((heads, tops))

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each query's score that its k-th best reaches in any case, and how many groups can still reach it."""
        heads, tops = shared.value
        starts: dict[int, Index] = {}
        for batch in batches:
            sizes, widths = (batch.column(c).to_numpy() for c in ("n", "width"))
            floor = np.full(batch.num_rows, -np.inf)
            for n in map(int, np.unique(sizes)):
                if n not in heads:
                    continue
                if n not in starts:
                    starts[n] = Index(*heads[n], max(1, n // 4))
                for some in np.array_split(np.flatnonzero(sizes == n), batch.num_rows // 512 + 1):
                    q = components_of(batch.column("q").take(pa.array(some)), n, widths[some])
                    row, _, scores = starts[n].search(batch.column("place").to_numpy()[some], q, floor[some], k)
                    lowest = np.full(len(some), np.inf)
                    np.minimum.at(lowest, row, scores.astype(np.float64))
                    full = np.bincount(row, minlength=len(some)) >= k
                    floor[some[full]] = lowest[full]
            # Lengths are rounded; the slack keeps the bound on the safe side.
            norm = batch.column("norm").to_numpy()
            need = (floor - 1.0) / np.maximum(norm, 1e-300) * (1 - 1e-9 * np.sign(floor))
            reach = np.where(norm * floor > 0, np.searchsorted(-tops, -need, side="right"), len(tops))
            reach = np.where((norm == 0) & (floor > 0), 0, reach)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(floor), pa.array(reach.astype(np.int32))], [*batch.schema.names, "floor", "reach"]
            )

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows arrive by group, within it by length of list, residents (role 0) before queries (role 1)."""
        heads, _ = shared.value
        key, places, ids, rows, index = None, [], [], [], None
        for batch in batches:
            part = np.stack([batch.column(c).to_numpy() for c in ("part", "n", "role")])
            cuts = np.flatnonzero(np.diff(part, axis=1).any(0)) + 1
            for at, to in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
                if at == to:
                    continue
                n, role = int(part[1, at]), int(part[2, at])
                if (part[0, at], n) != key:
                    key, places, ids, rows, index = (part[0, at], n), [], [], [], None
                own = batch.slice(at, to - at)
                place, number = own.column("place").to_numpy(), own.column("id").to_numpy()
                q = components_of(own.column("q"), n, own.column("width").to_numpy())
                if role == 0:
                    places.append(place)
                    ids.append(number)
                    rows.append(q)
                    continue
                if not ids:
                    continue
                if index is None:
                    basis = heads[n][3] if n in heads else np.eye(n)
                    index = Index(*map(np.concatenate, (places, ids, rows)), basis, max(1, n // 4))
                floor = own.column("floor").to_numpy()
                for a in range(0, len(number), 512):
                    row, vec, scores = index.search(place[a : a + 512], q[a : a + 512], floor[a : a + 512], k)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(place[a + row]), pa.array(number[a + row]), pa.array(vec), pa.array(scores)],
                        ["place", "query_id", "vec_id", "score"],
                    )

    by_range = spark.createDataFrame(
        [(r, int(b), g) for (r, g), b in zip(groups_of.items(), before)] or [(-1, 0, 1)], "range int, first long, groups long"
    )
    part = (F.col("first") + F.pmod(F.xxhash64("place"), F.col("groups"))).cast("int")
    kind = "id bigint, n int, width int, norm double, q binary, place bigint, floor double, reach int"
    asked = table.where(queries).mapInArrow(ask, kind).where("reach > 0")
    role, columns = F.col("role").cast("byte").alias("role"), ["place", "id", "width", "q", "floor"]
    residents = placed.join(F.broadcast(by_range), "range").withColumn("role", F.lit(0)).withColumn("floor", F.lit(0.0))
    asked = asked.withColumn("role", F.lit(1)).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("reach") - 1)))
    dealt = residents.select(part.alias("part"), "n", role, *columns).unionByName(asked.select("part", "n", role, *columns))
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), groups)
    dealt = dealt.repartition(tasks, "part").sortWithinPartitions("part", "n", "role")
    found = dealt.mapInArrow(search, "place bigint, query_id bigint, vec_id bigint, score bigint")
    order = Window.partitionBy("place").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
