"""First-arrival deduplication of final candles."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from candela import schemas as S

DEDUP_KEYS = ["symbol", "open_time_ts"]
ARRIVAL_ORDER = ["ingestion_timestamp", "source_system"]


def first_arrival(df: DataFrame, keys: list[str] = DEDUP_KEYS, order: list[str] = ARRIVAL_ORDER) -> DataFrame:
    """Batch form: per key the earliest arrival (ties broken by source), deterministic.

    Shuffle on the key only; groups are the copies of one candle.
    """
    others = [c for c in df.columns if c not in keys]
    # Last tie-break: a hash of the row, so a recomputed task picks the same copy.
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).asc_nulls_last() for c in order],
                                          F.xxhash64(*[F.col(c) for c in others]))
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def first_arrival_stream(df: DataFrame, keys: list[str] = DEDUP_KEYS, event_time: str = "open_time_ts",
                         lateness: str = S.DEDUP_WATERMARK) -> DataFrame:
    """Streaming form: state bounded by the watermark; rows later than it are dropped (use the
    batch backfill route for history, see streaming.runner)."""
    return df.withWatermark(event_time, lateness).dropDuplicates(keys)
