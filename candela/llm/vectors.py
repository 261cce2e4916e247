"""Vector columns: which rows can be compared, and numpy views of Arrow lists inside Spark tasks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def finite(vec: Column) -> Column:
    """Whether a vector and all its components are there and finite (never null)."""
    each = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    return vec.isNotNull() & F.coalesce(each, F.lit(False))


def matrices(column: pa.Array):
    """(row numbers, float64 matrix) for each vector length that a list column without nulls holds."""
    size = np.asarray(column.value_lengths())
    bounds = np.concatenate(([0], np.cumsum(size)))
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    for d in np.unique(size):
        at = np.flatnonzero(size == d)
        yield at, flat[bounds[at][:, None] + np.arange(d)]


def packed(rows: np.ndarray) -> list[bytes]:
    return [r.tobytes() for r in np.ascontiguousarray(rows)]


def unpacked(cell, width: int, kind=np.float64) -> np.ndarray:
    """A packed cell (bytes or a binary scalar) as rows of ``width`` values."""
    data = cell.as_buffer() if isinstance(cell, pa.Scalar) else cell
    x = np.frombuffer(data, kind)
    return x.reshape(-1, width) if width else x.reshape(0, 0)


def grouped(batches, keys: list[str], most: int):
    """Runs of equal ``keys`` in sorted batches, in pieces of up to ``most`` rows: (values of the keys, the rows). A piece may
    span batches; what is held is at most ``most`` rows and a batch."""
    rest = None
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = batch if rest is None else pa.Table.from_batches([rest, batch]).combine_chunks().to_batches()[0]
        cuts = _cuts(rows, keys)
        for lo, hi in zip(cuts[:-2], cuts[1:-1]):
            yield from _pieces(rows, keys, lo, hi, most)
        lo, n = cuts[-2], rows.num_rows
        while n - lo > most:
            yield from _pieces(rows, keys, lo, lo + most, most)
            lo += most
        rest = rows.slice(lo)
    if rest is not None and rest.num_rows:
        yield from _pieces(rest, keys, 0, rest.num_rows, most)


def _cuts(rows: pa.RecordBatch, keys: list[str]) -> list[int]:
    new = np.zeros(rows.num_rows, bool)
    new[0] = True
    for k in keys:
        v = rows.column(k).to_numpy(zero_copy_only=False)
        new[1:] |= v[1:] != v[:-1]
    return [*np.flatnonzero(new).tolist(), rows.num_rows]


def _pieces(rows: pa.RecordBatch, keys: list[str], lo: int, hi: int, most: int):
    for a in range(lo, hi, most):
        part = rows.slice(a, min(most, hi - a))
        yield tuple(part.column(k)[0].as_py() for k in keys), part
