"""Near duplicates by SimHash, with a tiled exact comparison of fingerprints.

Distinct fingerprints are grouped into tiles by the population counts of their four 16-bit blocks. Two
fingerprints within ``radius`` bits have counts whose differences add up to ``radius`` at most, so all other
pairs of tiles are skipped; the remaining pairs are compared completely, with numpy's exclusive or and bit
counts. Large tiles are cut into parts, so no task holds more than two blocks. Each task hands on a spanning
forest of the links it has found, never all pairs, and star contractions join them to components.

Missing texts count as empty; a text without words has fingerprint zero. Equal texts share a fingerprint and
so a component. Missing ids keep their rows; a component's id is its smallest id (missing if all are).
An empty table gives an empty table. Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardwarden.llm.bitmaps import keep_rows, text_hash
from cardwarden.llm.components import components
from cardwarden.llm.words import slices, split_words, spread
from cardwarden.session import settle_table

SEED = 42
_LANES = np.uint64(0x0001000100010001)
_LANE_MAX = 65535


def batch_fingerprints(column: pa.Array, shingle: int = 3, seed: int = SEED) -> np.ndarray:
    """SimHash (uint64) of each text: lower case A-Z, shingles of words, XXH64, majority of every bit."""
    return majority(*shingle_hashes(column, shingle, seed))


def shingle_hashes(column: pa.Array, shingle: int, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """XXH64 of all shingles in order, and their number in each text; fewer words than a shingle are one."""
    words = split_words(column, lower=True)
    counts = np.diff(words.bounds)
    ends = np.append(words.starts, 0)[:-1] + _word_sizes(words)
    sizes = ends - words.starts
    # All words of the batch one after the other, one space between them.
    begin = np.cumsum(sizes + 1) - (sizes + 1)
    joined = np.full(int((sizes + 1).sum()), 32, np.uint8)
    joined[spread(begin, sizes)] = words.flat[~words.space]
    data = memoryview(joined.tobytes())
    n = np.where(counts >= shingle, counts - shingle + 1, np.minimum(counts, 1))
    first = spread(words.bounds[:-1], n)
    last = first + np.repeat(np.minimum(counts, shingle), n) - 1
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter(
        (digest(data[a:b], seed) for a, b in zip(begin[first].tolist(), (begin[last] + sizes[last]).tolist())),
        np.uint64, len(first),
    )
    return hashes, n


def _word_sizes(words) -> np.ndarray:
    """Bytes of every word occurrence."""
    lengths = np.diff(np.frombuffer(words.distinct.buffers()[1], np.int64)[words.distinct.offset :][: len(words.distinct) + 1])
    return lengths[words.codes]


def majority(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Bits set in over half of each run of hashes. Four 16-bit counters are summed at a time, over runs short
    enough for them."""
    out = np.zeros(len(counts), np.uint64)
    pieces = -(-counts // _LANE_MAX)
    owner = np.repeat(np.arange(len(counts)), pieces)
    if not len(owner):
        return out
    starts = (np.cumsum(counts) - counts)[owner] + spread(np.zeros(len(counts), np.int64), pieces) * _LANE_MAX
    for shift in range(16):
        lanes = np.add.reduceat(hashes >> np.uint64(shift) & _LANES, starts)
        for lane in range(4):
            bit = 16 * lane + shift
            part = (lanes >> np.uint64(16 * lane) & np.uint64(0xFFFF)).astype(np.int64)
            total = np.bincount(owner, part, len(counts))
            out |= (2 * total > counts).astype(np.uint64) << np.uint64(bit)
    return out


def fingerprint_table(docs: DataFrame, id_col: str, text_col: str, shingle: int = 3, hashed: bool = False) -> DataFrame:
    """``(id, fp[, text_hash])``"""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            fp = pa.array(batch_fingerprints(batch.column(1), shingle).astype(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), fp, *batch.columns[2:]], ["id", "fp", *batch.schema.names[2:]])

    source = docs.select(
        F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"),
        *([text_hash(text_col).alias("text_hash")] if hashed else []),
    )
    kind = docs.schema[id_col].dataType.simpleString()
    return source.mapInArrow(run, f"id {kind}, fp bigint" + ", text_hash bigint" * hashed)


# --------------------------------------------------------------------------- tiles
def _neighbours(radius: int) -> list[tuple[int, int, int, int]]:
    steps = range(-radius, radius + 1)
    return [d for d in product(steps, repeat=4) if sum(map(abs, d)) <= radius]


def _tile_of(fps: np.ndarray) -> np.ndarray:
    counts = [np.bitwise_count(fps >> np.uint64(16 * i) & np.uint64(0xFFFF)).astype(np.int64) for i in range(4)]
    return counts[0] + 17 * (counts[1] + 17 * (counts[2] + 17 * counts[3]))


def _mixed(fps: np.ndarray) -> np.ndarray:
    """Bits that spread fingerprints over the parts of a tile."""
    return ((fps * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)).astype(np.int64)


def local_forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (node, smallest reachable node) that connect what the given links connect."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[x], root[y])
        new = root.copy()
        np.minimum.at(new, root[x], low)
        np.minimum.at(new, root[y], low)
        new = new[new]
        if np.array_equal(new, root):
            break
        root = new
    moved = root != np.arange(len(nodes))
    return nodes[moved], nodes[root[moved]]


def links_within(fps: DataFrame, radius: int = 2, part_rows: int | None = None) -> DataFrame:
    """``(a, b)``: links that connect exactly the fingerprints (column ``fp``, distinct) within ``radius`` bits
    of each other. ``part_rows``: fingerprints per part of a tile; only task sizes depend on it."""
    spark = fps.sparkSession
    blocks = [F.bit_count(F.shiftrightunsigned("fp", 16 * i).bitwiseAND(65535)) for i in range(4)]
    tile = blocks[0] + 17 * (blocks[1] + 17 * (blocks[2] + 17 * blocks[3]))
    # At most 17 ** 4 rows, however many fingerprints there are.
    sizes = np.zeros(17**4, np.int64)
    for r in fps.groupBy(tile.cast("int").alias("tile")).count().collect():
        sizes[r["tile"]] = r["count"]
    if part_rows is None:
        part_rows = max(512, int(sizes.sum()) // int(spark.conf.get("spark.sql.shuffle.partitions")))
    grid = np.stack(np.unravel_index(np.arange(17**4), (17,) * 4)[::-1])  # counts of each tile's blocks
    occupied = np.flatnonzero(sizes)
    # For each step to another tile: where a tile's copies go. A pair of tiles belongs to the smaller one.
    steps = []
    for d in _neighbours(radius):
        to = grid[:, occupied] + np.array(d)[:, None]
        inside = ((to >= 0) & (to <= 16)).all(0)
        home = np.where(inside, to[0] + 17 * (to[1] + 17 * (to[2] + 17 * to[3])), 0)
        target = np.full(17**4, -1, np.int64)
        target[occupied] = np.where(inside & (home < occupied) & (sizes[home] > 0), home, -1)
        if any(d) and (target >= 0).any():
            steps.append(target)
    visitors = sizes.copy()
    for target in steps:
        from_ = np.flatnonzero(target >= 0)
        np.add.at(visitors, target[from_], sizes[from_])
    own_parts = np.maximum(1, -(-sizes // part_rows))
    visit_parts = np.maximum(1, -(-visitors // part_rows))
    shared = spark.sparkContext.broadcast((steps, own_parts, visit_parts))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Every fingerprint to its tile's parts: as resident (role 0) and, there and in tiles nearby, as visitor."""
        steps, own_parts, visit_parts = shared.value

        def rows(fp, tile, own, visit, role):
            key = (tile << 40) + (own << 20) + visit
            return pa.RecordBatch.from_arrays(
                [pa.array(key), pa.array(np.full(len(fp), role, np.int8)), pa.array(fp.astype(np.int64))], ["home", "role", "fp"]
            )

        for batch in batches:
            fp = batch.column(0).to_numpy().astype(np.uint64)
            tile, mixed = _tile_of(fp), _mixed(fp)
            n = visit_parts[tile]
            each = np.repeat(np.arange(len(fp)), n)
            visit = spread(np.zeros(len(fp), np.int64), n)
            yield rows(fp[each], tile[each], (mixed % own_parts[tile])[each], visit, 0)
            for target in [np.arange(17**4), *steps]:
                home = target[tile]
                some = np.flatnonzero(home >= 0)
                if not len(some):
                    continue
                n = own_parts[home[some]]
                each = np.repeat(some, n)
                own = spread(np.zeros(len(some), np.int64), n)
                yield rows(fp[each], home[each], own, (mixed // 7919 % visit_parts[home])[each], 1)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows arrive sorted by home and role; residents of one home are kept, visitors stream past them."""
        home, residents = None, np.zeros(0, np.uint64)
        a, b, waiting = [], [], 0

        def flush():
            nonlocal a, b, waiting
            x, y = local_forest(np.concatenate(a), np.concatenate(b))
            a, b, waiting = [], [], 0
            return pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64)), pa.array(y.astype(np.int64))], ["a", "b"])

        for batch in batches:
            homes = batch.column(0).to_numpy()
            roles = batch.column(1).to_numpy()
            fps = batch.column(2).to_numpy().astype(np.uint64)
            cuts = np.flatnonzero((np.diff(homes) != 0) | (np.diff(roles) != 0)) + 1
            for at, to in zip([0, *cuts.tolist()], [*cuts.tolist(), len(homes)]):
                if at == to:
                    continue
                if homes[at] != home:
                    home, residents = homes[at], np.zeros(0, np.uint64)
                if roles[at] == 0:
                    residents = np.concatenate([residents, fps[at:to]])
                    continue
                step = max(1, 2_000_000 // max(1, len(residents)))
                for begin in range(at, to, step):
                    visitors = fps[begin : min(to, begin + step)]
                    near = np.bitwise_count(residents[:, None] ^ visitors[None, :]) <= radius
                    i, j = np.nonzero(near)
                    differ = residents[i] != visitors[j]
                    if differ.any():
                        a.append(residents[i[differ]])
                        b.append(visitors[j[differ]])
                        waiting += int(differ.sum())
                    if waiting > 1_000_000:
                        yield flush()
        if a:
            yield flush()

    dealt = fps.select("fp").mapInArrow(deal, "home bigint, role tinyint, fp bigint")
    # Comparisons outweigh bytes, so these tasks are not merged by size.
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return dealt.repartition(tasks, "home").sortWithinPartitions("home", "role").mapInArrow(compare, "a bigint, b bigint")


def near_duplicate_components(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = 2, shingle: int = 3
) -> DataFrame:
    """``(id, fingerprint, component_id)``, one row per document."""
    return _components(docs, id_col, text_col, radius, shingle).select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def _components(docs: DataFrame, id_col: str, text_col: str, radius: int, shingle: int, hashed: bool = False) -> DataFrame:
    table = settle_table(fingerprint_table(docs, id_col, text_col, shingle, hashed), "fingerprints")
    distinct = settle_table(table.groupBy("fp").agg(F.min("id").alias("least_id")), "distinct")
    roots = components(links_within(distinct, radius)).withColumnRenamed("node", "fp")
    nodes = distinct.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    smallest = nodes.groupBy("root").agg(F.min("least_id").alias("component_id"))
    named = nodes.join(smallest, "root").select("fp", "root", "component_id")
    return table.join(named, "fp").select("id", "fp", "root", "component_id", *(["text_hash"] if hashed else []))


def keep_first(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = 2, shingle: int = 3
) -> DataFrame:
    """The document with the smallest id of each component, with all its columns.

    Of rows that share this id (or all lack one) the one with the smallest fingerprint stays, then any one.
    """
    named = settle_table(_components(docs, id_col, text_col, radius, shingle, hashed=True), "components")
    own = F.col("id").eqNullSafe(F.col("component_id"))
    first = named.groupBy("root").agg(F.min(F.when(own, F.struct("fp", "text_hash"))).alias("first"))
    kept = own & (F.struct("fp", "text_hash") == F.col("first"))
    return keep_rows(docs, id_col, text_col, named.join(first, "root").select("id", "text_hash", kept.alias("kept")))
