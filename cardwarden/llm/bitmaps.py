"""Bitmaps of hashes with a fixed size, which keep rows that cannot matter out of shuffles.

A bitmap has no false negatives; a full one lets more rows pass to the exact joins behind it, never fewer.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Bits of a bitmap, as a power of two: 16 MB.
FILTER_BITS = 27


def bitmap(hashes: DataFrame, column: str) -> Broadcast:
    """A bitmap over the top bits of the hashes; at most 2 ** (FILTER_BITS - 6) rows reach the driver."""
    place = F.shiftrightunsigned(column, 64 - FILTER_BITS)
    bits = (
        hashes.select(F.shiftright(place, 6).cast("int").alias("word"), (place % 64).cast("int").alias("bit"))
        .groupBy("word")
        .agg(F.expr("bit_or(shiftleft(1L, bit))").alias("bits"))
        .toArrow()
    )
    out = np.zeros(1 << (FILTER_BITS - 6), np.int64)
    out[bits.column("word").to_numpy()] = bits.column("bits").to_numpy()
    return hashes.sparkSession.sparkContext.broadcast(out)


def in_bitmap(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    place = hashes >> np.uint64(64 - FILTER_BITS)
    word = bits.view(np.uint64)[(place >> np.uint64(6)).astype(np.int64)]
    return (word >> (place & np.uint64(63)) & np.uint64(1)).astype(bool)


def hash_longs(values: np.ndarray) -> np.ndarray:
    """What ``xxhash64`` gives for a long column."""
    raw = values.astype("<i8").tobytes()
    return np.fromiter((xxhash.xxh64_intdigest(raw[i : i + 8], 42) for i in range(0, len(raw), 8)), np.uint64, len(values))


def text_hash(text_col: str) -> Column:
    """What tells the texts of rows with one id apart; computed beside the row, so no text leaves the JVM for it."""
    return F.xxhash64(F.col(f"`{text_col}`").cast("string"))


def keep_rows(docs: DataFrame, id_col: str, text_col: str, decisions: DataFrame) -> DataFrame:
    """The rows of ``docs`` that ``decisions (id, text_hash, kept)`` keeps, with all their columns.

    Rows whose hash belongs to no document that goes, nor to one that occurs twice, stay where they are; only the
    others are joined. Of rows with the same id and text one stays. Python sees the hashes alone.
    """
    per_key = decisions.groupBy("id", "text_hash").agg(F.count("*").alias("times"), F.max("kept").alias("kept"))
    bits = bitmap(per_key.where(~F.col("kept") | (F.col("times") > 1)).select(F.col("text_hash").alias("h")), "h")

    def hit(hashes: pa.Array) -> pa.Array:
        return pa.array(in_bitmap(bits.value, hashes.to_numpy(zero_copy_only=False).astype(np.uint64)))

    doubt = F.arrow_udf(hit, "boolean")(F.col("text_hash"))
    flagged = docs.select(
        F.col(f"`{id_col}`").alias("id"), text_hash(text_col).alias("text_hash"),
        F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"),
    ).withColumn("doubt", doubt)
    kept = per_key.where("kept").select(F.col("id").alias("kept_id"), F.col("text_hash").alias("kept_hash"))
    same = F.col("id").eqNullSafe(F.col("kept_id")) & (F.col("text_hash") == F.col("kept_hash"))
    found = flagged.where("doubt").join(kept, same)
    order = Window.partitionBy("id", "text_hash").orderBy(F.xxhash64(*(F.col(f"row.`{c}`") for c in docs.columns)))
    first = found.withColumn("nth", F.row_number().over(order)).where("nth = 1").select("row.*")
    return flagged.where(~F.col("doubt")).select("row.*").unionByName(first)
