"""Sharding by a hypergeometric communication matrix (numbered operator 5), in DataFrame functions only.

A uniform shuffle of N rows into shards of exact sizes, in the way of parallel permutation: rows lie in P partitions (by
hash, about PART_ROWS each); the matrix of how many rows of each partition go to each shard is drawn exactly, from
the multivariate hypergeometric law that a uniform permutation of all rows would give; each partition is permuted and dealt out by its row of
the matrix; rows are exchanged; each shard is permuted again. Only the matrix (P x shards numbers, one row per PART_ROWS rows) is drawn on the
driver.

All "random" orders are seeded hashes of the row, so a lost task is recomputed alike. A shard is permuted in buckets of about
PART_ROWS rows (a bucket is a range of the hash), each bucket starting where the counts of those before it end, so no task
holds a shard. Rows equal in all columns are interchangeable.

Law `rows`: shard sizes differ by one at most. Defined results: nulls are values like others; repeated rows each get a place; an empty table
gives an empty result; columns named like an output are replaced.
"""

from __future__ import annotations

import json
import math
import random

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

PART_ROWS = 1 << 16
MIN_PARTS = 512
HASHES = ("__part", "__first", "__second")


def hypergeometric(rng: random.Random, good: int, bad: int, draws: int) -> int:
    """How many of ``draws`` without replacement are good: inversion outwards from the mode, a few standard deviations of
    steps, so any counts do."""
    lo, hi = max(0, draws - bad), min(draws, good)
    if lo == hi:
        return lo
    choose = lambda n, k: math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1)
    mode = min(hi, max(lo, (draws + 1) * (good + 1) // (good + bad + 2)))
    up = down = mode
    p_up = p_down = math.exp(choose(good, mode) + choose(bad, draws - mode) - choose(good + bad, draws))
    left = rng.random() - p_up
    while left > 0 and (up < hi or down > lo):
        if up < hi:
            p_up *= (good - up) * (draws - up) / ((up + 1) * (bad - draws + up + 1))
            up += 1
            left -= p_up
            if left <= 0:
                return up
        if down > lo:
            p_down *= down * (bad - draws + down) / ((good - down + 1) * (draws - down + 1))
            down -= 1
            left -= p_down
            if left <= 0:
                return down
    return mode


def communication_matrix(parts: list[int], shards: list[int], seed: int) -> list[list[int]]:
    """A random matrix with these row and column sums, as a uniform permutation would give it."""
    rng, rest, out = random.Random(seed), list(shards), []
    for n in parts:
        row, pool = [], sum(rest)
        for k, room in enumerate(rest):
            x = hypergeometric(rng, room, pool - room, n)
            row.append(x)
            pool, n = pool - room, n - x
            rest[k] -= x
        out.append(row)
    return out


def shuffle_into_shards(df: DataFrame, n_shards: int = 16, seed: int = 20240229, part_rows: int = PART_ROWS) -> DataFrame:
    """All rows and columns of ``df`` with ``shard`` (0 to n_shards - 1) and ``slot`` (gapless from 0 in each shard)."""
    rows = df.drop("shard", "slot", *HASHES)
    names = [f"`{c}`" for c in rows.columns]
    h = lambda k: F.xxhash64(F.lit(seed + k), *names)
    total = rows.count()
    n_parts = max(MIN_PARTS, -(-total // part_rows))
    rows = rows.select("*", F.pmod(h(0), F.lit(n_parts)).alias("__part"), h(1).alias("__first"), h(2).alias("__second"))

    counts = {r["__part"]: r["count"] for r in rows.groupBy("__part").count().toLocalIterator()}
    parts = sorted(counts)
    sizes = [total // n_shards + (s < total % n_shards) for s in range(n_shards)]
    edges = []
    for p, row in zip(parts, communication_matrix([counts[p] for p in parts], sizes, seed)):
        ends, at = [], 0
        for x in row:
            at += x
            ends.append(at)
        edges.append({"__p": p, "__ends": ends})
    matrix = df.sparkSession.range(1).select(F.inline(F.from_json(F.lit(json.dumps(edges)), "array<struct<__p:bigint,__ends:array<bigint>>>")))

    # permute locally and deal out: the k-th row of a partition goes to the shard whose stretch holds k
    k = F.row_number().over(Window.partitionBy("__part").orderBy("__first", "__second"))
    dealt = rows.withColumn("__k", k).join(matrix, F.col("__part") == F.col("__p"))
    dealt = dealt.withColumn("shard", F.size(F.filter("__ends", lambda e: e < F.col("__k")))).drop("__part", "__first", "__k", "__p", "__ends")

    # exchange and permute again, bucket by bucket
    n_buckets = max(MIN_PARTS // n_shards, -(-total // (n_shards * part_rows)))
    dealt = dealt.withColumn("__bucket", F.shiftright(F.shiftrightunsigned("__second", 33) * F.lit(n_buckets), 31))
    before = Window.partitionBy("shard").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = dealt.groupBy("shard", "__bucket").count().select(
        F.col("shard").alias("__s"), F.col("__bucket").alias("__b"), F.coalesce(F.sum("count").over(before), F.lit(0)).alias("__start"))
    inside = F.row_number().over(Window.partitionBy("shard", "__bucket").orderBy("__second", *names))
    placed = dealt.withColumn("__in", inside).join(starts, (F.col("shard") == F.col("__s")) & (F.col("__bucket") == F.col("__b")))
    return placed.withColumn("slot", F.col("__start") + F.col("__in") - 1).drop("__second", "__bucket", "__in", "__s", "__b", "__start")
