"""Words of whole texts in Arrow batches: maximal runs of bytes other than ``[\\x20\\x09-\\x0D]``."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

#: Bytes of text handled at a time inside a task; only memory depends on it, never a result.
SLICE_BYTES = 2 << 20


def slices(batches: Iterator[pa.RecordBatch], text: str, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Batches cut so that each has about ``size`` bytes of text, one row at least; missing texts are empty."""
    for batch in batches:
        at = batch.schema.get_field_index(text)
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(at)), 0).to_numpy().astype(np.int64))
        begin = 0
        while begin < batch.num_rows:
            before = ends[begin - 1] if begin else 0
            end = max(begin + 1, int(np.searchsorted(ends, before + size, side="right")))
            part = batch.slice(begin, end - begin)
            column = pc.fill_null(part.column(at).cast(pa.large_string()), "")
            yield part.set_column(at, pa.field(text, pa.large_string()), column)
            begin = end


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a column of texts, and where each text starts (one more entry for the end)."""
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    flat = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return flat, offsets - offsets[0]


@dataclass
class Words:
    """``codes``: the words of all texts in order, as indices into ``distinct``; ``bounds``: the words of text
    i are bounds[i]:bounds[i + 1]; ``space``: which bytes are white space."""

    codes: np.ndarray
    distinct: pa.Array
    bounds: np.ndarray
    space: np.ndarray
    flat: np.ndarray
    starts: np.ndarray


def split_words(column: pa.Array, lower: bool = False) -> Words:
    """``column``: large strings without nulls. ``lower``: A-Z become a-z first."""
    flat, offsets = text_bytes(column)
    if lower:
        flat = flat | ((flat >= 65) & (flat <= 90)).astype(np.uint8) << 5
    space = SPACE[flat]
    begins = ~space
    cut = np.zeros(len(flat) + 1, bool)
    cut[offsets] = True
    begins[1:] &= space[:-1] | cut[1:-1]
    starts = np.flatnonzero(begins)
    kept = flat[~space]
    # Positions in the text without white space are the offsets of the words' own buffer.
    before = np.cumsum(~space, dtype=np.int64) - 1
    word_offsets = np.append(before[starts], len(kept)).astype(np.int64)
    words = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(word_offsets), pa.py_buffer(kept))
    coded = words.dictionary_encode()
    codes = coded.indices.to_numpy().astype(np.int64)
    return Words(codes, coded.dictionary, np.searchsorted(starts, offsets), space, flat, starts)


class WordCache:
    """What a function gives for words, kept between batches of a worker up to a number of words.

    ``compute(words) -> (flat values, values per word)``. Only time depends on the limit.
    """

    def __init__(self, compute: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], limit: int = 400_000):
        self._compute, self._limit = compute, limit
        self._reset()

    def _reset(self) -> None:
        self._slots: dict[str, int] = {}
        self._sizes = np.zeros(0, np.int64)
        self._flat = np.zeros(0, np.int32)

    def get(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Flat values, and where the values of each given word begin and how many there are."""
        if len(self._slots) > self._limit:
            self._reset()
        slots = np.fromiter(map(self._slots.get, words, repeat(-1)), np.int64, len(words))
        new = np.flatnonzero(slots < 0)
        if len(new):
            fresh = [words[i] for i in new]
            flat, sizes = self._compute(fresh)
            slots[new] = np.arange(len(self._slots), len(self._slots) + len(fresh))
            self._slots.update(zip(fresh, slots[new].tolist()))
            self._sizes = np.append(self._sizes, sizes)
            self._flat = np.append(self._flat, flat.astype(np.int32))
        begin = np.cumsum(self._sizes) - self._sizes
        return self._flat, begin[slots], self._sizes[slots]


def spread(begin: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Indices begin, begin + 1, ... of runs of the given sizes, one after the other."""
    total = int(sizes.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(sizes)
    return np.arange(total) + np.repeat(begin - (ends - sizes), sizes)
