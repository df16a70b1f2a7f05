"""Quantised vectors with exact integer inner products, whatever the size of their components.

A vector travels as the bytes of its integer components in the narrowest of four forms (``width``): 2 and 4 are
signed integers of so many bytes, 8 is an integer of eight bytes, 9 a double that holds an integer beyond those.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_FORMS = {2: np.dtype("<i2"), 4: np.dtype("<i4"), 8: np.dtype("<i8"), 9: np.dtype("<f8")}
_LIMITS = ((2, 2.0**15), (4, 2.0**31), (8, 2.0**62), (9, np.inf))


def encode_rows(x: np.ndarray, scale: int) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Width, norm and bytes of each row of doubles after flooring ``scale`` times its components."""
    q = np.floor(x * scale)
    most = np.abs(q).max(1)
    width = np.full(len(q), 9)
    for form, limit in reversed(_LIMITS):
        width[most < limit] = form
    # Scaled by a power of two first, so that squares of huge components stay finite.
    power = np.exp2(np.frexp(np.maximum(most, 1.0))[1])
    norms = np.sqrt(np.square(q / power[:, None]).sum(1)) * power
    raw: list[bytes] = [b""] * len(q)
    for form in np.unique(width):
        some = np.flatnonzero(width == form)
        data = q[some].astype(_FORMS[int(form)])
        for i, row in zip(some.tolist(), data):
            raw[i] = row.tobytes()
    return width, norms, raw


def matrix(column: pa.Array, n: int, width: int) -> np.ndarray:
    """Rows of a binary column, all of ``n`` components of one width."""
    form = _FORMS[width]
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    flat = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return np.frombuffer(flat.tobytes(), form).reshape(-1, n)


def exact_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All inner products as longs: in floating point where that is exact, in 64-bit integers where they hold the
    sums, else in unbounded integers. A score beyond a long is an error."""
    if not len(a) or not len(b):
        return np.zeros((len(a), len(b)), np.int64)
    most = [float(np.abs(x.astype(np.float64)).max()) for x in (a, b)]
    bound = most[0] * most[1] * a.shape[1]
    if bound < 2.0**53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    if bound < 2.0**62:
        return a.astype(np.int64) @ b.astype(np.int64).T
    whole = np.vectorize(int, otypes=[object])
    scores = np.dot(whole(a), whole(b).T)
    if any(not -(2**63) <= s < 2**63 for s in scores.ravel().tolist()):
        raise OverflowError("an inner product leaves the range of a long")
    return scores.astype(np.int64)


def quantised(vectors: DataFrame, id_col: str, vector_col: str, scale: int, *others: str) -> DataFrame:
    """``(id long, others..., n int, width int, norm double, q binary)`` of the vectors that take part: neither missing
    nor empty, all components present and finite. ``others``: SQL expressions ``... AS name`` over the input's columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(batch.num_columns - 1)
            sizes = np.diff(lists.offsets.to_numpy())
            flat = lists.values.slice(lists.offsets[0].as_py(), int(sizes.sum()))
            x = flat.fill_null(np.nan).to_numpy(zero_copy_only=False)
            begin = np.cumsum(sizes) - sizes
            for n in np.unique(sizes):
                some = np.flatnonzero(sizes == n)
                rows = x[begin[some][:, None] + np.arange(n)]
                fine = np.isfinite(rows * scale).all(1)
                some, rows = some[fine], rows[fine]
                if not len(some):
                    continue
                width, norms, raw = encode_rows(rows, scale)
                own = [c.take(pa.array(some)) for c in batch.columns[:-1]]
                yield pa.RecordBatch.from_arrays(
                    [
                        *own, pa.array(np.full(len(some), n, np.int32)), pa.array(width.astype(np.int32)), pa.array(norms),
                        pa.array(raw, pa.binary()),
                    ],
                    [*batch.schema.names[:-1], "n", "width", "norm", "q"],
                )

    vector = F.col(f"`{vector_col}`").cast("array<double>")
    rows = vectors.select(F.col(f"`{id_col}`").cast("long").alias("id"), *map(F.expr, others), vector.alias("x"))
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    return rows.where("x IS NOT NULL AND size(x) > 0").mapInArrow(run, f"{kinds}, n int, width int, norm double, q binary")
