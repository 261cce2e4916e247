"""Surrogate keys without funnelling a table through one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from candela.session import scratch_path


def dense_sequence_id(df: DataFrame, order_by: list[str], name: str = "id",
                      num_partitions: int | None = None) -> DataFrame:
    """1-based consecutive ids in ``order_by`` order, like ``row_number() over (order by ...)``.

    A global window would move every row into one task. Instead the rows are range-partitioned
    on the order key and written once to shared storage with their partition number; each
    partition's count gives the running offsets (one row per partition), and each row gets offset +
    its rank inside its partition. Counts and ranks read that one copy: two range shuffles of the
    same rows sample their bounds separately and may disagree on the partition of a row.
    """
    n = num_partitions or df.sparkSession.sparkContext.defaultParallelism
    path = scratch_path(df.sparkSession, "ids")
    (df.repartitionByRange(n, *order_by).withColumn("_part", F.spark_partition_id()).write.parquet(path))
    ranged = df.sparkSession.read.parquet(path)
    counts = ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select(
        "_part",
        F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)).alias("_off"))
    within = Window.partitionBy("_part").orderBy(*order_by)
    return (ranged.join(offsets, "_part")
                  .withColumn(name, (F.col("_off") + F.row_number().over(within)).cast("int"))
                  .drop("_part", "_off"))


def stable_hash_id(*cols) -> "F.Column":
    """Order-free id that never changes when other keys are added (63 bits of xxhash64, non-negative).
    Equal ids of different keys are possible: check distinct ids against distinct keys where that matters."""
    return F.xxhash64(*cols).bitwiseAND(F.lit((1 << 63) - 1))
