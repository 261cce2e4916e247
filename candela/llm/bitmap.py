"""A bitmap of fixed size over 64-bit hashes: a first test that lets tasks skip rows a join would drop.

Its size (2 MB) does not depend on the data, so it can be broadcast; a false hit costs a row, never a result.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BITS = 24


def build(hashes: DataFrame, column: str):
    """A broadcast bitmap of 2^BITS bits with the bit of each hash's top bits set: or-ed in Spark as 64-bit pieces,
    so at most 2^(BITS - 6) rows reach the driver, in one job whatever the number of partitions."""
    at = F.shiftrightunsigned(F.col(column), 64 - BITS)
    pieces = (hashes.select(F.shiftright(at, 6).alias("piece"), F.expr("1L").alias("one"), (at % 64).cast("int").alias("bit"))
              .groupBy("piece").agg(F.bit_or(F.expr("shiftleft(one, bit)")).alias("bits")))
    out = np.zeros(1 << (BITS - 6), dtype=np.uint64)
    found = pieces.toArrow()
    out[found.column("piece").to_numpy()] = found.column("bits").to_numpy().view(np.uint64)
    return hashes.sparkSession.sparkContext.broadcast(out)


def holds(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    at = h >> np.uint64(64 - BITS)
    return (bits[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) != 0
