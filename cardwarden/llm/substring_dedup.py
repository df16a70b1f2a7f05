"""Removal of word windows that occur more than once, over a sparse De Bruijn graph.

The graph's edges are k-mers of words, sampled: every window of ``window`` words is represented by its smallest
k-mer (by hash), its anchor, so equal windows share their anchor. Anchors seen once are dropped. For the others,
the neighbourhood (all words of the windows that an anchor represents) tells how the path goes on around it:

* where a neighbourhood occurs twice or more, the path does not branch there, and all its windows are repeated
  at a time: these compact into spans;
* an anchor with several neighbourhoods, one of them seen once, is a branch. Only there are windows compared one
  by one, by 128-bit hashes, and joined back to their source coordinates (text digest, word number).

Spans are gathered per text and joined to the texts. Between the scans of the texts, small bitmaps of hashes (of
fixed size) keep anchors that cannot matter out of the shuffles; a full bitmap lets more rows pass, never fewer,
and the joins behind are exact.

Missing and empty texts, and texts shorter than a window, keep all their words. Rows of equal text are each
other's copies, so all windows of such texts go. An empty table gives an empty table. Ids may be missing or
repeated: sources are found by their text. Only the named columns are read; others are handed on in ``row``. In
:func:`without_repeated` missing texts become empty.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardwarden.llm.bitmaps import bitmap, in_bitmap
from cardwarden.llm.words import Words, slices, split_words, spread
from cardwarden.session import settle_table

#: Words of a k-mer.
K = 16
#: Bytes of text at a time; a task holds some 60 times as much in arrays of word positions.
SLICE = 1 << 20
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Rolling:
    """Hashes of any run of words, from running sums."""

    def __init__(self, word_hashes: np.ndarray, base: int, longest: int):
        self._base, n = base, len(word_hashes)
        # Word i counts base ** -i, so that runs are differences of one running sum, shifted back.
        inverse = pow(base, -1, 1 << 64)
        down = _powers(inverse, n)
        self._sums = np.concatenate([[np.uint64(0)], np.cumsum(word_hashes * down, dtype=np.uint64)])
        self._up = _powers(base, n + 1)

    def of(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self._sums[end] - self._sums[begin]) * self._up[begin]


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(max(1, n), np.uint64)
    done, power = 1, base
    while done < n:
        step = min(done, n - done)
        out[done : done + step] = out[:step] * np.uint64(power & ((1 << 64) - 1))
        done, power = done + step, power * power & ((1 << 64) - 1)
    return out[:n]


@dataclass
class Anchors:
    """For each anchor: its hash, its text in the batch, its first window (word number in the text) and how many
    windows it stands for; ``at`` is the first window's word number in the batch."""

    hashes: np.ndarray
    text: np.ndarray
    first: np.ndarray
    windows: np.ndarray
    at: np.ndarray
    offset: np.ndarray
    rolling: tuple[Rolling, Rolling]


def anchors(words: Words, window: int, k: int = K) -> Anchors | None:
    raw = [x.as_buffer() for x in words.distinct]
    hashed = [
        np.fromiter((xxhash.xxh64_intdigest(x, seed) for x in raw), np.uint64, len(raw))[words.codes] for seed in (1, 2)
    ]
    counts = np.diff(words.bounds)
    starts = np.maximum(0, counts - window + 1)
    text = np.repeat(np.arange(len(counts)), starts)
    if not len(text):
        return None
    rolling = tuple(Rolling(h, b, window) for h, b in zip(hashed, _BASES))
    first = spread(np.zeros(len(counts), np.int64), starts)
    at = words.bounds[text] + first
    every = np.arange(len(words.codes) - k + 1)
    kmers = _mix(rolling[0].of(every, every + k))
    least, where = kmers[at].copy(), np.zeros(len(at), np.int64)
    for j in range(1, window - k + 1):
        value = kmers[at + j]
        less = value < least
        least[less] = value[less]
        where[less] = j
    anchor = at + where
    new = np.ones(len(at), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])
    run = np.flatnonzero(new)
    size = np.diff(np.append(run, len(at)))
    return Anchors(_mix(least[run] ^ np.uint64(0x5851F42D4C957F2D)), text[run], first[run], size, at[run], where[run], rolling)


def _text_keys(words: Words, batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """96 bits of a digest of each text."""
    digests = [xxhash.xxh3_128_intdigest(x.as_buffer()) for x in batch.column(1)]
    low = np.array([d & ((1 << 64) - 1) for d in digests], np.uint64).astype(np.int64)
    high = np.array([d >> 64 & 0xFFFFFFFF for d in digests], np.uint32).astype(np.int32)
    return low, high


def _scan(docs: DataFrame, emit: Callable, schema: str, text_col: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SLICE):
            words = split_words(batch.column(1))
            out = emit(words, batch)
            if out is not None:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in out], names)

    names = [c.split()[0] for c in schema.split(",")]
    texts = docs.select(F.lit(0).alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return texts.mapInArrow(run, schema)


def repeated_spans(docs: DataFrame, window: int, text_col: str = "text", k: int = K) -> DataFrame:
    """``(k1, k2, spans array<struct<lo, n>>)``: for each text that has any, the first words of its repeated
    windows, as runs of ``n`` from ``lo``."""
    if not 0 < k <= window:
        raise ValueError("a k-mer has to fit into a window")

    def edges(words: Words, batch: pa.RecordBatch):
        found = anchors(words, window, k)
        if found is None:
            return None
        hashes, counts = np.unique(found.hashes, return_counts=True)
        return hashes.astype(np.int64), np.minimum(counts, 2).astype(np.int32)

    seen = _scan(docs, edges, "a bigint, n int", text_col).groupBy("a").agg(F.sum("n").alias("n"))
    repeated = bitmap(seen.where("n > 1"), "a")

    def paths(words: Words, batch: pa.RecordBatch):
        found = anchors(words, window, k)
        if found is None:
            return None
        some = np.flatnonzero(in_bitmap(repeated.value, found.hashes))
        at, size = found.at[some], found.windows[some]
        around = _mix(found.rolling[1].of(at, at + size + window - 1)) ^ _mix((size << 16 | found.offset[some]).astype(np.uint64))
        k1, k2 = _text_keys(words, batch)
        text = found.text[some]
        return (
            found.hashes[some].astype(np.int64), around.astype(np.int64), k1[text], k2[text],
            found.first[some].astype(np.int32), size.astype(np.int32),
        )

    steps = settle_table(_scan(docs, paths, "a bigint, around bigint, k1 bigint, k2 int, lo int, n int", text_col), "paths")
    counts = settle_table(steps.groupBy("a", "around").agg(F.count("*").alias("times")), "neighbourhoods")
    unbranched = steps.join(counts.where("times > 1").select("a", "around"), ["a", "around"], "left_semi")
    branching = counts.groupBy("a").agg(F.count("*").alias("ways"), F.min("times").alias("least"))
    branches = bitmap(branching.where("ways > 1 and least = 1"), "a")

    def windows(words: Words, batch: pa.RecordBatch):
        found = anchors(words, window, k)
        if found is None:
            return None
        some = np.flatnonzero(in_bitmap(branches.value, found.hashes))
        size = found.windows[some]
        at, lo = spread(found.at[some], size), spread(found.first[some], size)
        text = np.repeat(found.text[some], size)
        k1, k2 = _text_keys(words, batch)
        hashes = [_mix(r.of(at, at + window)).astype(np.int64) for r in found.rolling]
        return *hashes, k1[text], k2[text], lo.astype(np.int32)

    single = settle_table(_scan(docs, windows, "w1 bigint, w2 bigint, k1 bigint, k2 int, lo int", text_col), "windows")
    twice = single.groupBy("w1", "w2").agg(F.count("*").alias("times")).where("times > 1").select("w1", "w2")
    at_branches = single.join(twice, ["w1", "w2"], "left_semi").select("k1", "k2", "lo", F.lit(1).alias("n"))
    spans = unbranched.select("k1", "k2", "lo", "n").unionByName(at_branches).distinct()
    return spans.groupBy("k1", "k2").agg(F.collect_list(F.struct("lo", "n")).alias("spans"))


def remove_repeated(
    docs: DataFrame, window: int = 35, id_col: str = "doc_id", text_col: str = "text", rows: bool = False, k: int = K
) -> DataFrame:
    """``(id, n_words, n_removed, kept_sha256[, left, row])``. ``left``: the words that stay, joined by a space, or
    the text itself if it loses none; ``row``: the other columns."""
    spans = repeated_spans(docs, window, text_col, k)
    columns = [F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text")]
    if rows:
        others = [F.col(f"`{c}`") for c in docs.columns if c != text_col]
        columns.append(F.struct(*others, F.lit(0).alias("_")).alias("row"))
    source = docs.select(*columns)

    def key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SLICE):
            k1, k2 = _text_keys(None, batch)
            extra = [batch.column(i) for i in range(2, batch.num_columns)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1).cast(pa.string()), pa.array(k1), pa.array(k2), *extra],
                ["id", "text", "k1", "k2", "row"][: 4 + len(extra)],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    row_type = f", row {source.schema['row'].dataType.simpleString()}" if rows else ""
    keyed = source.mapInArrow(key, f"id {kind}, text string, k1 bigint, k2 int" + row_type)
    joined = keyed.join(spans, ["k1", "k2"], "left").select("id", "text", "spans", *(["row"] if rows else []))

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SLICE):
            words = split_words(batch.column(1))
            counts = np.diff(words.bounds)
            lists = batch.column(2)
            sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            flat = lists.flatten()
            owner = np.repeat(np.arange(batch.num_rows), sizes)
            lo = words.bounds[owner] + flat.field("lo").to_numpy(zero_copy_only=False)
            change = np.zeros(len(words.codes) + 1, np.int64)
            np.add.at(change, lo, 1)
            np.add.at(change, lo + flat.field("n").to_numpy(zero_copy_only=False) + window - 1, -1)
            gone = np.cumsum(change[:-1]) > 0
            removed = np.add.reduceat(np.append(gone, False), words.bounds[:-1], dtype=np.int64) if len(counts) else counts
            removed = np.where(counts > 0, removed, 0)
            kept_bounds = np.concatenate([[0], np.cumsum(counts - removed)]).astype(np.int64)
            left = words.distinct.take(pa.array(words.codes[~gone]))
            kept = pc.binary_join(pa.ListArray.from_arrays(kept_bounds.astype(np.int32), left), pa.scalar(" ", pa.large_string()))
            sha = [hashlib.sha256(x.as_buffer() or b"").hexdigest() for x in kept]
            out = [batch.column(0), pa.array(counts.astype(np.int64)), pa.array(removed), pa.array(sha, pa.string())]
            if rows:
                same = pc.if_else(pa.array(removed > 0), kept, batch.column(1))
                out += [same.cast(pa.string()), batch.column(3)]
            yield pa.RecordBatch.from_arrays(out, ["id", "n_words", "n_removed", "kept_sha256", "left", "row"][: len(out)])

    schema = f"id {kind}, n_words bigint, n_removed bigint, kept_sha256 string" + (", left string" + row_type) * rows
    return joined.mapInArrow(remove, schema).withColumnRenamed("id", id_col)


def without_repeated(docs: DataFrame, window: int = 35, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents with their columns; texts that lose words become the words left, joined by a space."""
    done = remove_repeated(docs, window, id_col, text_col, rows=True)
    return done.select(*(F.col("left").alias(c) if c == text_col else F.col(f"row.`{c}`").alias(c) for c in docs.columns))
