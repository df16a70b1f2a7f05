"""Exact duplicates by composable polynomial fingerprints.

A text is normalised (each run of ASCII white space becomes one space) and cut into chunks; every chunk has
its polynomial hash, all chunks of a batch at a time, and the hash of a text is put together from its chunks by
``hash(ab) = hash(a) * base ** len(b) + hash(b)`` modulo two primes. Texts of equal length and fingerprint are
then compared chunk by chunk: the smallest and the largest chunk at every place of a group must be the same,
which pre-aggregates in the tasks, so a group of any size costs one row per task and place. Groups that differ
somewhere (equal fingerprints by chance) are divided by the SHA-256 of the text.

Missing texts count as empty; empty texts are equal to each other. Missing ids come after all others. Rows that
share the smallest id of a group are told apart by their place in the input: exactly one row of a group stays.
An empty table gives an empty table. Only the named columns are read.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardwarden.llm.bitmaps import bitmap, hash_longs, in_bitmap, keep_rows, text_hash
from cardwarden.llm.words import SPACE, slices, spread, text_bytes
from cardwarden.session import settle, settle_table

#: Two primes below 2**31 and the bases used with them.
PRIMES = (2147483647, 2147483629)
BASES = (911382323, 972663749)
CHUNK = 4096
#: Bytes of text handled at a time; a byte needs some forty bytes of memory meanwhile.
SLICE = 2 << 20
#: Bytes per row of the streaming comparison.
COMPARED = 16384


def normalised_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts with runs of white space as one space, and the bounds of the texts."""
    flat, offsets = text_bytes(column)
    space = SPACE[flat]
    again = np.zeros(len(flat), bool)
    again[1:] = space[1:] & space[:-1]
    inner = offsets[(offsets > 0) & (offsets < len(flat))]
    again[inner] = False
    kept = np.where(space, np.uint8(32), flat)[~again]
    gone = np.concatenate([[0], np.cumsum(again)])
    return kept, offsets - gone[offsets]


def chunk_hashes(data: np.ndarray, begins: np.ndarray, sizes: np.ndarray, prime: int, base: int) -> np.ndarray:
    """Hash of each run ``data[begin:begin + size]`` of 1 to ``CHUNK`` bytes; the runs cover ``data`` in order."""
    powers = np.ones(CHUNK, np.uint64)
    for i in range(1, CHUNK):
        powers[i] = int(powers[i - 1]) * base % prime
    if not len(sizes):
        return np.zeros(0, np.uint64)
    behind = np.repeat(begins + sizes, sizes) - 1 - np.arange(len(data))
    # Below 2**8 * 2**31 * 2**12, so sums of a chunk fit in 64 bits. Bytes count from 1: zeros matter.
    return np.add.reduceat(powers[behind] * (data.astype(np.uint64) + np.uint64(1)), begins) % np.uint64(prime)


def combine(left: np.ndarray, right: np.ndarray, right_size: np.ndarray, prime: int, base: int) -> np.ndarray:
    """Hashes of ab from the hashes of a and b and the length of b."""
    shift = np.ones(len(right), np.uint64)
    power, size = np.uint64(base), right_size.astype(np.uint64)
    while size.any():
        shift = np.where(size & np.uint64(1), shift * power % np.uint64(prime), shift)
        power = power * power % np.uint64(prime)
        size = size >> np.uint64(1)
    return (left * shift + right) % np.uint64(prime)


def fingerprints(data: np.ndarray, bounds: np.ndarray, primes=PRIMES, bases=BASES) -> np.ndarray:
    """A fingerprint (int64) for each text of a batch."""
    sizes = np.diff(bounds)
    chunks = -(-sizes // CHUNK)
    owner = np.repeat(np.arange(len(sizes)), chunks)
    nth = spread(np.zeros(len(sizes), np.int64), chunks)
    begins = bounds[owner] + nth * CHUNK
    chunk_size = np.minimum(CHUNK, bounds[owner + 1] - begins)
    out = np.zeros(len(sizes), np.uint64)
    first = np.cumsum(chunks) - chunks
    for prime, base in zip(primes, bases):
        hashes = chunk_hashes(data, begins, chunk_size, prime, base)
        total = np.zeros(len(sizes), np.uint64)
        # All texts at a time, chunk by chunk, while they have one.
        todo, n = np.flatnonzero(chunks > 0), 0
        while len(todo):
            at = first[todo] + n
            total[todo] = combine(total[todo], hashes[at], chunk_size[at], prime, base)
            n += 1
            todo = todo[chunks[todo] > n]
        out = out << np.uint64(31) | total
    return out.astype(np.int64)


def _fingerprinted(docs: DataFrame, id_col: str, text_col: str, what: str, primes, bases, bits=None, hashed=False) -> DataFrame:
    """``what``: "sums" for ids and digests (and ``text_hash`` if ``hashed``), "texts" for the normalised bytes of texts in ``bits``."""
    sums = what == "sums"
    columns = [F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text")]
    if hashed:
        columns.append(text_hash(text_col).alias("text_hash"))
    rows = docs.select(*columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, place = uuid.uuid4().hex, 0
        for batch in slices(batches, "text", SLICE):
            data, bounds = normalised_bytes(batch.column(1))
            prints = fingerprints(data, bounds, primes, bases)
            keys = [pa.array(np.diff(bounds)), pa.array(prints)]
            if not sums:
                texts = pa.LargeBinaryArray.from_buffers(
                    pa.large_binary(), len(bounds) - 1, [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(data)]
                )
                out = pa.RecordBatch.from_arrays([*keys, texts], ["n", "fp", "bytes"])
                out = out.filter(pa.array(in_bitmap(bits.value, hash_longs(prints))))
                yield out.set_column(2, "bytes", out.column(2).cast(pa.binary()))
                continue
            digest, n = text_digests(data, bounds), batch.num_rows
            out = [batch.column(0), *keys, pa.array(digest, pa.string()), pa.array([part] * n, pa.string())]
            out += [pa.array(np.arange(place, place + n)), *batch.columns[2:]]
            place += n
            yield pa.RecordBatch.from_arrays(out, ["id", "n", "fp", "sha", "part", "place", *batch.schema.names[2:]])

    if not sums:
        return rows.mapInArrow(run, "n bigint, fp bigint, bytes binary")
    schema = f"id {docs.schema[id_col].dataType.simpleString()}, n bigint, fp bigint, sha string, part string, place bigint"
    schema += ", text_hash bigint" * hashed
    return rows.mapInArrow(run, schema)


def text_digests(data: np.ndarray, bounds: np.ndarray) -> list[str]:
    view = memoryview(data.tobytes())
    return [hashlib.sha256(view[a:b]).hexdigest() for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]


def exact_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", primes=PRIMES, bases=BASES
) -> DataFrame:
    """One row per document: ``(id, keep_id, group_size, kept, text_sha256)``."""
    return _groups(docs, id_col, text_col, primes, bases).select(
        F.col("id").alias(id_col), "keep_id", "group_size", "kept", F.col("sha").alias("text_sha256")
    )


def _groups(docs: DataFrame, id_col: str, text_col: str, primes=PRIMES, bases=BASES, hashed: bool = False) -> DataFrame:
    sums = settle_table(_fingerprinted(docs, id_col, text_col, "sums", primes, bases, hashed=hashed), "sums")
    repeated = sums.groupBy("n", "fp").agg(F.count("*").alias("members")).where("members > 1").select("n", "fp")
    bits = bitmap(repeated.select(F.xxhash64("fp").alias("h")), "h")
    # A text that comes along by chance is a group of its own, whose chunks equal themselves.
    texts = _fingerprinted(docs, id_col, text_col, "texts", primes, bases, bits)
    places = F.sequence(F.lit(0), F.greatest(F.ceil(F.col("n") / COMPARED) - 1, F.lit(0)).cast("int"))
    compared = (
        texts.select("n", "fp", "bytes", F.explode(places).alias("at"))
        .select("n", "fp", "at", F.substring("bytes", F.col("at") * COMPARED + 1, F.lit(COMPARED)).alias("chunk"))
        .groupBy("n", "fp", "at")
        .agg(F.min("chunk").alias("least"), F.max("chunk").alias("most"))
    )
    chance = settle(compared.where("least <> most").select("n", "fp").distinct())
    keyed = sums.withColumn("sub", F.lit(""))
    if not chance.isEmpty():
        keyed = sums.join(chance.withColumn("split", F.lit(True)), ["n", "fp"], "left").withColumn(
            "sub", F.when(F.col("split"), F.col("sha")).otherwise("")
        )
    first = F.min(F.struct(F.col("id").isNull().alias("last"), "id", "part", "place"))
    groups = keyed.groupBy("n", "fp", "sub").agg(F.count("*").alias("group_size"), first.alias("keep"))
    kept = (F.col("part") == F.col("keep.part")) & (F.col("place") == F.col("keep.place"))
    return keyed.join(groups, ["n", "fp", "sub"]).select(
        "id", "sha", F.col("keep.id").alias("keep_id"), "group_size", kept.alias("kept"), *(["text_hash"] if hashed else [])
    )


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The first row, by id, of every group of equal texts, with all its columns."""
    groups = _groups(docs, id_col, text_col, hashed=True).select("id", "text_hash", "kept")
    return keep_rows(docs, id_col, text_col, settle_table(groups, "groups"))
