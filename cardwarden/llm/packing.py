"""Packing of tokenised documents by shortest-pack-first over the length histogram.

Documents are cut into pieces of ``capacity`` ids and a rest. The histogram of piece lengths is worked off from
the longest length down: copies of a length go to the shortest packs that still have room, a whole group of
equal packs at a time, and open new packs where none has. The result is a short list of patterns, each with a
number of copies. Pieces are joined to patterns by their rank among the pieces of their length; ranks come
from running counts inside each task plus the counts of the tasks before it, so no length, however frequent, is
ranked in one task. The driver sees the histogram (at most ``capacity`` rows) and the patterns made from it.

Missing texts count as empty and are packed (their end id). Repeated rows are packed as often as they occur;
ids may be missing. An empty table gives an empty table. Only the named columns are read.
"""

from __future__ import annotations

import uuid
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cardwarden.llm.word_bpe import load
from cardwarden.llm.words import WordCache, slices, split_words, spread
from cardwarden.session import settle_table

_CACHES: dict[str, WordCache] = {}

PIECE = "start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"


def token_pieces(
    docs: DataFrame, vocabulary: str, capacity: int, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """``(id, start, length, ids_crc32, doc_tokens, part, place[, ids])``, one row per piece. ``part`` names the
    task run, ``place`` counts the pieces of the same length in it from 0; both hold only once stored."""
    with open(vocabulary, encoding="utf-8") as f:
        shared = docs.sparkSession.sparkContext.broadcast(f.read())
    kind = docs.schema[id_col].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        content = shared.value
        if content not in _CACHES:
            _CACHES.clear()
            _CACHES[content] = WordCache(load(content).encode)
        cache = _CACHES[content]
        part = uuid.uuid4().hex
        seen = np.zeros(capacity + 1, np.int64)
        for batch in slices(batches, "text"):
            words = split_words(batch.column(1))
            values, begin, size = cache.get(words.distinct.to_pylist())
            sizes = size[words.codes]
            ends = np.concatenate([[0], np.cumsum(sizes)])[words.bounds[1:]]
            ids = np.insert(values[spread(begin[words.codes], sizes)], ends, end_id).astype("<u4")
            doc_ends = ends + np.arange(1, batch.num_rows + 1)
            doc_tokens = np.diff(doc_ends, prepend=0)
            pieces = -(-doc_tokens // capacity)
            owner = np.repeat(np.arange(batch.num_rows), pieces)
            start = spread(np.zeros(batch.num_rows, np.int64), pieces) * capacity
            length = np.minimum(capacity, doc_tokens[owner] - start)
            at = (doc_ends - doc_tokens)[owner] + start
            raw = memoryview(ids.tobytes())
            crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(at.tolist(), (at + length).tolist())]
            order = np.argsort(length, kind="stable")
            runs = np.bincount(length, minlength=capacity + 1)
            place = np.zeros(len(length), np.int64)
            place[order] = spread(np.zeros(capacity + 1, np.int64), runs)
            place += seen[length]
            seen += runs
            columns = [
                batch.column(0).take(pa.array(owner)), pa.array(start), pa.array(length), pa.array(crc, pa.int64()),
                pa.array(doc_tokens[owner]), pa.array([part] * len(owner), pa.string()), pa.array(place),
            ]
            if with_ids:
                bounds = np.append(at, at[-1] + length[-1] if len(at) else 0).astype(np.int32)
                columns.append(pa.ListArray.from_arrays(bounds, ids.astype(np.int32)))
            names = ["id", "start", "length", "ids_crc32", "doc_tokens", "part", "place", "ids"]
            yield pa.RecordBatch.from_arrays(columns, names[: len(columns)])

    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    schema = f"id {kind}, {PIECE}, part string, place bigint" + ", ids array<int>" * with_ids
    return rows.mapInArrow(cut, schema)


def shortest_pack_first(histogram: dict[int, int], capacity: int) -> list[tuple[list[tuple[int, int]], int]]:
    """Patterns ``([(length, copies), ...], number of packs)`` that hold every piece of the histogram."""
    groups: dict[int, list[tuple[list[tuple[int, int]], int]]] = defaultdict(list)  # by room left
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        # The shortest packs have the most room. A pack takes as many copies as fit.
        for room in sorted((r for r in groups if r >= length), reverse=True):
            while left and groups[room]:
                pattern, packs = groups[room].pop()
                copies = room // length
                used = min(packs, left // copies)
                if used:
                    groups[room - copies * length].append(([*pattern, (length, copies)], used))
                    left -= used * copies
                    packs -= used
                if packs and left and left < copies:
                    groups[room - left * length].append(([*pattern, (length, left)], 1))
                    left, packs = 0, packs - 1
                if packs:
                    groups[room].append((pattern, packs))
                    break
            if not groups[room]:
                del groups[room]
            if not left:
                break
        if left:
            copies = capacity // length
            if left // copies:
                groups[capacity - copies * length].append(([(length, copies)], left // copies))
            if rest := left % copies:
                groups[capacity - rest * length].append(([(length, rest)], 1))
    return [group for room in sorted(groups) for group in groups[room]]


def pack(
    docs: DataFrame, vocabulary: str, capacity: int = 2048, end_id: int = 1, id_col: str = "doc_id",
    text_col: str = "text", with_ids: bool = False,
) -> DataFrame:
    """``(id, start, length, ids_crc32, doc_tokens, sequence_id, offset[, ids])``, one row per piece; a sequence
    holds pieces without gaps from offset 0 and at most ``capacity`` ids."""
    pieces = settle_table(token_pieces(docs, vocabulary, capacity, end_id, id_col, text_col, with_ids), "pieces")
    counts = pieces.groupBy("part", "length").agg(F.count("*").alias("n"))
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    earlier = counts.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier"))
    ranked = pieces.join(earlier, ["part", "length"]).withColumn("rank", F.col("earlier") + F.col("place"))

    # For each length: the ranks at which its patterns begin, and what a pattern does with them.
    tables: dict[int, list[tuple[int, int, int, int]]] = defaultdict(list)
    first_rank: dict[int, int] = defaultdict(int)
    sequence = 0
    for pattern, packs in shortest_pack_first(histogram, capacity):
        offset = 0
        for length, copies in pattern:
            tables[length].append((first_rank[length], copies, sequence, offset))
            first_rank[length] += copies * packs
            offset += copies * length
        sequence += packs
    places = {length: np.array(rows, np.int64).T for length, rows in tables.items()}
    names = ["id", "start", "length", "ids_crc32", "doc_tokens", *(["ids"] if with_ids else [])]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = batch.column("length").to_numpy()
            ranks = batch.column("rank").to_numpy()
            sequence_id, offset = np.zeros(len(ranks), np.int64), np.zeros(len(ranks), np.int64)
            for length in np.unique(lengths):
                which = np.flatnonzero(lengths == length)
                begins, copies, sequences, offsets = places[int(length)]
                row = np.searchsorted(begins, ranks[which], side="right") - 1
                pack_no, slot = np.divmod(ranks[which] - begins[row], copies[row])
                sequence_id[which] = sequences[row] + pack_no
                offset[which] = offsets[row] + slot * length
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in names), pa.array(sequence_id), pa.array(offset)],
                [*names, "sequence_id", "offset"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"id {kind}, {PIECE}" + ", ids array<int>" * with_ids + ", sequence_id bigint, offset bigint"
    return ranked.select(*names, "rank").mapInArrow(place, schema).withColumnRenamed("id", id_col)
