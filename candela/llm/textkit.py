"""Vectorised word work on Arrow string columns, used inside Spark tasks.

A batch's UTF-8 buffer is scanned once with numpy: word bounds, 64-bit word hashes and n-gram hashes
come from array operations, so no Python object is made per word. Words never cross rows; null and
empty texts have none. Work is cut into chunks of a few MB of text, so memory per task is
bounded by the chunk (or one longer text), not by the Arrow batch.
"""

from __future__ import annotations

import contextlib
import ctypes
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHUNK_BYTES = 2 << 20

_U = np.uint64
_MULT = _U(0x9E3779B97F4A7C15 | 5)          # odd, 5 mod 8: invertible, full multiplicative order
_INV = _U(pow(int(_MULT), -1, 1 << 64))
_BYTE_VALUES = np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=np.uint64) * _U(2) + _U(1)
_GRAM = _U(0xD6E8FEB86659FD93)


#: Bytes whose running sum is made at once, so that tables and sums stay small beside the executor's heap.
SPAN_BYTES = 1 << 16


def _powers(base: np.uint64) -> np.ndarray:
    """base^0 .. base^SPAN_BYTES."""
    with np.errstate(over="ignore"):
        step = np.full(SPAN_BYTES + 1, base, dtype=np.uint64)
        step[0] = 1
        return np.multiply.accumulate(step)


_POWER, _INVERSE_POWER = _powers(_MULT), _powers(_INV)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Bytes of words that end at white space: everything but space, tab, \n, \v, \f and \r.
SPACE_WORD = np.ones(256, dtype=bool)
SPACE_WORD[[9, 10, 11, 12, 13, 32]] = False
#: Bytes of alphanumeric words (after lower-casing): digits, a-z and all bytes of non-ASCII characters.
ALNUM_WORD = np.zeros(256, dtype=bool)
ALNUM_WORD[48:58] = ALNUM_WORD[97:123] = ALNUM_WORD[128:] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (array in, array out)."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def string_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, bounds) of a string column; nulls count as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    _, offs, data = column.buffers()
    n = len(column)
    bounds = np.frombuffer(offs, dtype=np.int64 if wide else np.int32, count=n + 1,
                           offset=column.offset * (8 if wide else 4)).astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[bounds[0]:bounds[-1]], bounds - bounds[0]


def chunks(batch: pa.RecordBatch, column: str, max_bytes: int = CHUNK_BYTES):
    """Slices of ``batch`` with about ``max_bytes`` of text each (one longer text stands alone)."""
    _, bounds = string_buffers(batch.column(column))
    lo, n = 0, batch.num_rows
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(bounds, bounds[lo] + max_bytes, "right")) - 1)
        yield batch.slice(lo, hi - lo)
        lo = hi


@dataclass
class Words:
    """The words of a chunk of texts: byte bounds, the first word index of each row, 64-bit hashes."""

    buf: np.ndarray      # bytes, lower-cased if asked for
    bounds: np.ndarray   # byte bounds of the rows
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray    # words of row i are first[i]..first[i+1]
    hash: np.ndarray

    @property
    def n_rows(self) -> int:
        return len(self.first) - 1

    def row_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(self.n_rows), np.diff(self.first))

    def text(self, i: int, j: int) -> str:
        """Words i..j joined by one space."""
        b = self.buf
        return b" ".join(b[s:e].tobytes() for s, e in zip(self.start[i:j], self.end[i:j])).decode("utf-8", "replace")

    def grams(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(hash of the k words from each word on, whether they lie in one row)."""
        return grams(self.hash, self.first, k)


def span_hashes(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte spans of ``buf``, in ascending order and without overlap, from running polynomial sums over
    stretches of at most SPAN_BYTES; a longer span is summed up piece by piece."""
    raw, lo = np.empty(len(start), dtype=np.uint64), 0
    with np.errstate(over="ignore"):
        while lo < len(start):
            at = int(start[lo])
            hi = int(np.searchsorted(end, at + SPAN_BYTES, "right"))
            if hi <= lo:
                raw[lo] = _long_sum(buf[at:end[lo]])
                lo += 1
                continue
            part = buf[at:end[hi - 1]]
            total = np.zeros(len(part) + 1, dtype=np.uint64)
            np.cumsum(_BYTE_VALUES[part] * _POWER[:len(part)], out=total[1:])
            s, e = start[lo:hi] - at, end[lo:hi] - at
            raw[lo:hi] = (total[e] - total[s]) * _INVERSE_POWER[s]
            lo = hi
        return mix(raw + (end - start).astype(np.uint64) * _GRAM)


def _long_sum(span: np.ndarray) -> np.uint64:
    out, scale = 0, 1
    for at in range(0, len(span), SPAN_BYTES):
        part = span[at:at + SPAN_BYTES]
        out += scale * int((_BYTE_VALUES[part] * _POWER[:len(part)]).sum(dtype=np.uint64))
        scale = scale * int(_POWER[SPAN_BYTES]) % (1 << 64)
    return _U(out % (1 << 64))


def grams(h: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    n = len(h)
    left = np.repeat(first[1:], np.diff(first)) - np.arange(n)  # words from here to the row's end
    if n < k:
        return np.zeros(n, np.uint64), np.zeros(n, bool)
    with np.errstate(over="ignore"):
        g = np.zeros(n, dtype=np.uint64)
        m = n - k + 1
        for j in range(k):
            g[:m] = g[:m] * _GRAM + h[j:j + m]
        return mix(g + _U(k)), left >= k


def words(column: pa.Array, table: np.ndarray, lower: bool) -> Words:
    buf, bounds = string_buffers(column)
    if lower:
        buf = LOWER[buf]
    inside = table[buf]
    if not len(buf):
        z = np.zeros(0, np.int64)
        return Words(buf, bounds, z, z, np.zeros(len(bounds), np.int64), np.zeros(0, np.uint64))
    full = bounds[:-1][np.diff(bounds) > 0]
    before = np.empty(len(buf), bool)
    before[0], before[1:] = False, inside[:-1]
    before[full] = False
    start = np.flatnonzero(inside & ~before)
    after = np.empty(len(buf), bool)
    after[-1], after[:-1] = False, inside[1:]
    after[full[1:] - 1] = False
    end = np.flatnonzero(inside & ~after) + 1
    return Words(buf, bounds, start, end, np.searchsorted(start, bounds), span_hashes(buf, start, end))


def text_column(df: DataFrame, text: str = "text"):
    return F.col(f"`{text}`").cast("string")


def release() -> None:
    """Hand freed memory back to the system at a task's end: workers live on between tasks, beside the executor's heap."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only glibc has it
        ctypes.CDLL(None).malloc_trim(0)


_KEPT: dict[str, tuple[dict, ...]] = {}


def keep(module: str, *tables: dict) -> None:
    """Name the tables that tasks of ``module`` leave in their worker for its later tasks."""
    _KEPT[module] = tables


def drop_others(module: str) -> None:
    """Empty what other modules keep in this worker."""
    for owner, tables in _KEPT.items():
        if owner != module:
            for t in tables:
                t.clear()


def handing_back(run):
    """``run`` over a task's batches, without what other operators keep in the worker, and ``release`` after it, when what its
    frame held is free as well."""
    module = run.__module__

    def whole(batches):
        drop_others(module)
        yield from run(batches)
        release()
    return whole
