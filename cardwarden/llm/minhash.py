"""Near duplicates by circulant MinHash: distinct word shingles, banding, exact Jaccard similarity.

Two permutations of the 64-bit numbers give all coordinates of a signature: the first scatters the shingles' hashes,
the second is applied again and again to them, shifted circularly by one more step for each coordinate, and the least
value counts. Equal sets of shingles are one node. Nodes that agree in all coordinates of a band meet in a bucket; a
pair of similarity 0.85 meets in none with a probability below 1e-7.

Links are found without listing the pairs of a bucket: all its nodes are compared with one of them, the pivot, set
against set. Buckets whose nodes are not yet in one component are then cut into parts of a bounded weight, and tasks
compare two parts at a time by matrix products over the shingles that they share, handing on a spanning forest. So no
link inside a bucket is lost, and a bucket of copies costs one comparison a node. One whose texts mostly miss the
similarity is compared completely: the rows that move grow with its size times its parts, the products with its square.

Texts are equal in lower case A-Z and by words; fewer words than a shingle are one shingle. Texts without words, and
missing ones, have no shingles and link with nothing; their component is their own id. Missing ids keep their rows; a
component's id is its smallest id (missing if all are); repeated rows share a component. An empty table gives an
empty table. Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardwarden.llm.bitmaps import bitmap, in_bitmap
from cardwarden.llm.components import components
from cardwarden.llm.simhash import local_forest, shingle_hashes
from cardwarden.llm.words import slices
from cardwarden.session import settle_table

#: Coordinates of a band, and bands.
ROWS, BANDS = 5, 28
#: Shingles of a part of a bucket (a node counts 128 more), shingles of one product, rows of tiles in a task.
WEIGHT, CHUNK, TASK = 1 << 18, 2048, 4000
#: Bytes of text handled at a time.
SLICE = 1 << 20

_ONE, _TWO = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_SHIFT = np.uint64(0x9E3779B97F4A7C15)


def permuted(x: np.ndarray, first: int = 30, second: int = 27, last: int = 31) -> np.ndarray:
    """A permutation of the 64-bit numbers: each step can be undone."""
    x = (x ^ (x >> np.uint64(first))) * _ONE
    x = (x ^ (x >> np.uint64(second))) * _TWO
    return x ^ (x >> np.uint64(last))


def shingle_sets(column: pa.Array, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each text's distinct shingles, ascending, and their numbers."""
    hashes, n = shingle_hashes(column, shingle)
    owner = np.repeat(np.arange(len(n)), n)
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    return hashes[new], np.bincount(owner[new], minlength=len(n))


def signatures(hashes: np.ndarray, n: np.ndarray, size: int) -> np.ndarray:
    """(sets, size): coordinate k is the least of the second permutation, shifted k times, over the first one's values.
    Sets must not be empty."""
    out = np.empty((len(n), size), np.uint64)
    if not len(n):
        return out
    starts = np.cumsum(n) - n
    at = permuted(hashes, 33, 29, 32)
    for k in range(size):
        out[:, k] = np.minimum.reduceat(permuted(at), starts)
        at += _SHIFT  # one circular step, modulo 2 ** 64
    return out


def band_keys(signature: np.ndarray, rows: int = ROWS, bands: int = BANDS) -> np.ndarray:
    """(sets, bands): one number for all coordinates of a band; bands don't share numbers but by chance."""
    out = np.empty((len(signature), bands), np.uint64)
    for band in range(bands):
        key = np.full(len(signature), band + 1, np.uint64)
        for column in range(band * rows, (band + 1) * rows):
            key = permuted(key * _SHIFT + signature[:, column])
        out[:, band] = key
    return out


def set_names(hashes: np.ndarray, n: np.ndarray) -> list[bytes]:
    """128 bits for each set of ascending hashes."""
    raw, ends = memoryview(hashes.astype("<u8").tobytes()), np.cumsum(n) * 8
    return [xxhash.xxh3_128_digest(raw[a:b]) for a, b in zip((ends - n * 8).tolist(), ends.tolist())]


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))


def signed(docs: DataFrame, id_col: str, text_col: str, shingle: int, rows: int, bands: int) -> DataFrame:
    """``(id, n_shingles, key, bands)``; key and bands are missing where a text has no shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SLICE):
            hashes, n = shingle_sets(batch.column(1), shingle)
            some = np.flatnonzero(n)
            keys: list[bytes | None] = [None] * len(n)
            for i, name in zip(some.tolist(), set_names(hashes, n[some])):
                keys[i] = name
            flat = band_keys(signatures(hashes, n[some], rows * bands), rows, bands).astype(np.int64).ravel()
            offsets = np.concatenate([[0], np.cumsum(np.where(n > 0, bands, 0))]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n.astype(np.int64)), pa.array(keys, pa.binary()), lists], ["id", "n_shingles", "key", "bands"]
            )

    kind = docs.schema[id_col].dataType.simpleString()
    return _rows(docs, id_col, text_col).mapInArrow(run, f"id {kind}, n_shingles bigint, key binary, bands array<bigint>")


def _sets(rows: DataFrame, wanted: DataFrame, shingle: int) -> DataFrame:
    """``(key, grams)``: the whole shingle sets of the wanted keys."""
    bits = bitmap(wanted.select(F.xxhash64("key").alias("h")), "h")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SLICE):
            hashes, n = shingle_sets(batch.column(1), shingle)
            names = set_names(hashes, n)
            places = np.fromiter((xxhash.xxh64_intdigest(x, 42) for x in names), np.uint64, len(names))
            some = np.flatnonzero(in_bitmap(bits.value, places) & (n > 0))
            some = np.array(sorted({names[i]: i for i in some.tolist()}.values()), np.int64)  # each set once
            offsets = np.concatenate([[0], np.cumsum(n)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(hashes.astype(np.int64)))
            keys = pa.array([names[i] for i in some.tolist()], pa.binary())
            yield pa.RecordBatch.from_arrays([keys, lists.take(pa.array(some))], ["key", "grams"])

    found = rows.mapInArrow(run, "key binary, grams array<bigint>").join(wanted, "key", "left_semi")
    return found.groupBy("key").agg(F.first("grams").alias("grams"))


def _alike(first: str, second: str, percent: int) -> str:
    """Whether sets of these sizes can have the similarity."""
    return f"100 * least({first}, {second}) >= {percent} * greatest({first}, {second})"


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``(a, b)`` whose whole sets have the similarity."""
    pairs = settle_table(pairs.select("a", "b").distinct(), "pairs")
    first, second = (sets.select(F.col("key").alias(k), F.col("grams").alias(x)) for k, x in (("a", "x"), ("b", "y")))
    shared = F.size(F.array_intersect("x", "y")).cast("long")
    both = pairs.join(second, "b").join(first, "a")
    # Shared of the union is shared / (x + y - shared).
    links = both.where((100 + percent) * shared >= percent * (F.size("x") + F.size("y")).cast("long"))
    return settle_table(links.select("a", "b"), "links")


def _links(rows: DataFrame, nodes: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Links ``(a, b)`` between nodes ``(key, n, bands)`` that connect what all links connect."""
    # Smaller sets are alike only if they are equal.
    nodes = nodes.where(f"100 * n >= {percent} * (n + 1)")
    members = nodes.select("key", "n", F.explode(F.array_distinct("bands")).alias("h"))
    shared = members.groupBy("h").agg(F.count("*").alias("size"), F.min(F.struct("key", "n")).alias("pivot")).where("size > 1")
    meet = settle_table(members.join(shared, "h"), "meet")
    sets = settle_table(_sets(rows, settle_table(meet.select("key").distinct(), "wanted"), shingle), "sets")
    pairs = meet.where(f"key <> pivot.key AND {_alike('n', 'pivot.n', percent)}")
    links = _confirmed(pairs.select(F.col("pivot.key").alias("a"), F.col("key").alias("b")), sets, percent)
    # A quarter of the buckets first: what they connect needs no second look in the others.
    for turn in ("pmod(h, 4) = 0", "pmod(h, 4) <> 0"):
        roots = components(links).withColumnRenamed("node", "key")
        # Of two nodes one was the pivot.
        placed = meet.where(f"size > 2 AND {turn}").select("h", "key", "n").join(roots, "key", "left")
        placed = settle_table(placed.withColumn("root", F.coalesce("root", "key")), "placed")
        found = settle_table(_tiles(placed, sets).mapInArrow(_tile_links(percent), "a binary, b binary"), "links")
        links = settle_table(links.unionByName(found), "links")
    return links


def _tiles(placed: DataFrame, sets: DataFrame) -> DataFrame:
    """``(h, i, j, part, key, root, grams)``, tile by tile: the nodes of parts i and j of a bucket that isn't one component.
    Of buckets with the same nodes one is taken."""
    mixed = [F.sum(F.xxhash64(F.lit(i), "key").cast("decimal(20,0)")) for i in range(2)]
    buckets = placed.groupBy("h").agg(
        F.min("root").alias("low"), F.max("root").alias("high"), F.sum(F.col("n") + 128).alias("weight"), F.hash(*mixed).alias("x"),
        F.xxhash64(*mixed).alias("y"),
    )
    parts = F.ceil(F.col("weight") / WEIGHT).cast("int")
    buckets = buckets.where("low <> high").groupBy("x", "y", "weight").agg(F.min("h").alias("h")).select("h", parts.alias("parts"))
    own = F.pmod(F.xxhash64("key", "h"), F.col("parts")).cast("int")
    rows = placed.join(settle_table(buckets, "buckets"), "h").select("h", "key", "root", "parts", own.alias("part"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    rows = settle_table(rows.select("h", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"), "part", "key", "root"), "tiles")
    number = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), rows.count() // TASK)
    return rows.join(sets, "key").select(*rows.columns, "grams").repartition(number, "h", "i", "j").sortWithinPartitions("h", "i", "j")


def _tile_links(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tile, rows = None, []
        for batch in batches:
            place = np.stack([batch.column(c).to_numpy() for c in ("h", "i", "j")])
            cuts = np.flatnonzero(np.diff(place, axis=1).any(0)) + 1
            for at, to in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
                if at == to:
                    continue
                if tile != (new := tuple(place[:, at].tolist())):
                    if rows:
                        yield _compared(pa.Table.from_batches(rows).combine_chunks(), percent)
                    tile, rows = new, []
                rows.append(batch.slice(at, to - at))
        if rows:
            yield _compared(pa.Table.from_batches(rows).combine_chunks(), percent)

    return run


def _compared(tile: pa.Table, percent: int) -> pa.RecordBatch:
    """A spanning forest of the links between nodes of different roots in a tile: within one part, or across two."""
    part, lists, n = tile.column("part").to_numpy(), tile.column("grams").combine_chunks(), tile.num_rows
    size = pc.list_value_length(lists).to_numpy().astype(np.int64)
    root = tile.column("root").combine_chunks().dictionary_encode().indices.to_numpy()
    first = np.flatnonzero(part == tile.column("i")[0].as_py())
    second = first if tile.column("i")[0].as_py() == tile.column("j")[0].as_py() else np.setdiff1d(np.arange(n), first)
    _, gram, times = np.unique(lists.flatten().to_numpy(), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(n), size)
    shared = times[gram] > 1
    owner, gram = owner[shared], (np.cumsum(times > 1) - 1)[gram[shared]]
    order = np.argsort(gram, kind="stable")
    owner, gram = owner[order], gram[order]
    both = np.zeros((len(first), len(second)), np.float32)
    for at in range(0, int(gram[-1]) + 1 if len(gram) else 0, CHUNK):
        some = slice(*np.searchsorted(gram, [at, at + CHUNK]))
        holds = np.zeros((n, CHUNK), np.float32)
        holds[owner[some], gram[some] - at] = 1
        both += holds[first] @ holds[second].T
    enough = (100 + percent) * both.astype(np.int64) >= percent * (size[first][:, None] + size[second])
    i, j = np.nonzero(enough & (root[first][:, None] != root[second]))
    a, b = local_forest(first[i], second[j])
    key = tile.column("key").combine_chunks()
    return pa.RecordBatch.from_arrays([key.take(pa.array(a)), key.take(pa.array(b))], ["a", "b"])


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, percent: int = 85, rows: int = ROWS,
    bands: int = BANDS,
) -> DataFrame:
    """``(id, n_shingles, component_id, kept)``, one row per document. Texts link if ``percent`` hundredths of the shingles
    that either holds are in both. For a lower ``percent`` take fewer ``rows`` or more ``bands``."""
    table = settle_table(signed(docs, id_col, text_col, shingle, rows, bands), "signatures")
    nodes = table.where("key IS NOT NULL").groupBy("key").agg(
        F.min("id").alias("least_id"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands")
    )
    nodes = settle_table(nodes, "nodes")
    roots = components(_links(_rows(docs, id_col, text_col), nodes, shingle, percent)).withColumnRenamed("node", "key")
    placed = nodes.select("key", "least_id").join(roots, "key", "left").withColumn("root", F.coalesce("root", "key"))
    smallest = placed.groupBy("root").agg(F.min("least_id").alias("component_id"))
    named = placed.join(smallest, "root").select("key", "component_id")
    found = table.where("key IS NOT NULL").join(named, "key").select("id", "n_shingles", "component_id")
    alone = table.where("key IS NULL").select("id", "n_shingles", F.col("id").alias("component_id"))
    out = found.unionByName(alone).withColumn("kept", F.col("id").eqNullSafe(F.col("component_id")))
    return out.withColumnRenamed("id", id_col)
