"""Exact token counts at every prefix of a text, by prefix dynamic programming.

Whole texts are cut at ASCII white space; each distinct word is solved once (``word_bpe``), giving the count
of each of its prefixes; running sums over the words of a text give the count at every prefix of the text.
Questions about truncation and budgets read that array and never encode again.

Missing and empty texts have an empty array and no tokens. Rows are independent: repeated rows, ties and
missing ids pass through; an empty table gives an empty table. Only the named id and text columns are read, so
further columns, whatever their names, don't matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardwarden.llm.word_bpe import load
from cardwarden.llm.words import WordCache, slices, split_words, spread

_CACHES: dict[str, WordCache] = {}


def prefix_token_counts(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, n_bytes long, prefix_tokens array<int>)``: element i (from 1) is the number of tokens of the
    first i characters. ``vocabulary``: path of a tokenizer file readable by the driver."""
    with open(vocabulary, encoding="utf-8") as f:
        shared = docs.sparkSession.sparkContext.broadcast(f.read())
    kind = docs.schema[id_col].dataType.simpleString()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        content = shared.value
        if content not in _CACHES:
            _CACHES.clear()
            _CACHES[content] = WordCache(load(content).prefix_counts)
        cache = _CACHES[content]
        for batch in slices(batches, "text"):
            texts = batch.column(1)
            words = split_words(texts)
            flat, begin, size = cache.get(words.distinct.to_pylist())
            at = spread(begin[words.codes], size[words.codes])
            counts = flat[at].astype(np.int64)
            # Within a word the step to the next prefix; between words nothing is added.
            steps = np.diff(counts, prepend=0)
            first = (np.cumsum(size[words.codes]) - size[words.codes])
            steps[first] = counts[first]
            characters = (words.flat & 0xC0) != 0x80
            total = np.zeros(int(characters.sum()), np.int64)
            total[~words.space[characters]] = steps
            total = np.cumsum(total)
            lengths = pc.utf8_length(texts).to_numpy().astype(np.int64)
            ends = np.cumsum(lengths)
            base = np.concatenate([[0], total])[ends - lengths]
            total = (total - np.repeat(base, lengths)).astype(np.int32)
            offsets = np.concatenate([[0], ends]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pc.binary_length(texts).cast(pa.int64()), pa.ListArray.from_arrays(offsets, total)],
                ["id", "n_bytes", "prefix_tokens"],
            )

    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    out = rows.mapInArrow(count, f"id {kind}, n_bytes bigint, prefix_tokens array<int>")
    return out.withColumnRenamed("id", id_col)


def total_tokens(counts: Column) -> Column:
    """Tokens of the whole text."""
    return F.when(F.size(counts) == 0, 0).otherwise(F.element_at(counts, -1)).cast("long")


def tokens_of_first(counts: Column, characters: Column | int) -> Column:
    """Tokens of the text cut behind so many characters (of the whole text, if it is shorter)."""
    n = F.least(F.lit(characters), F.size(counts)) if isinstance(characters, int) else F.least(characters, F.size(counts))
    return F.when(n <= 0, 0).otherwise(F.element_at(counts, F.greatest(n, F.lit(1)).cast("int"))).cast("long")


def characters_within(counts: Column, budget: int) -> Column:
    """The longest prefix, in characters, that has at most ``budget`` tokens. A longer prefix may have fewer
    tokens than a shorter one, so the last fitting one is taken."""
    fits = F.transform(counts, lambda n, i: F.when(n <= budget, i + 1).otherwise(F.lit(0)))
    return F.when(F.size(counts) == 0, 0).otherwise(F.array_max(fits)).cast("long")
