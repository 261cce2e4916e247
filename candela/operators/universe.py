"""Tradable universe: listing filter, candidate checks and listing timestamps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candela import schemas as S


def tradable(listing: DataFrame) -> DataFrame:
    """Listed symbols quoted in the universe's quote asset and currently trading."""
    return listing.filter((F.col("quoteAsset") == S.UNIVERSE_QUOTE_ASSET) & (F.col("status") == S.UNIVERSE_STATUS))


def flag_candidates(candidates: DataFrame, universe: DataFrame, key: str = "symbol") -> DataFrame:
    """``candidates`` with ``in_universe``: those kept (a semi join's answer) and those dropped (an anti join's) from one join."""
    u = universe.select(key).distinct().withColumn("in_universe", F.lit(True))
    return candidates.join(u, key, "left").withColumn("in_universe", F.coalesce("in_universe", F.lit(False)))


def first_seen(candles: DataFrame, key: str = "symbol", ts: str = "open_time_ts") -> DataFrame:
    """First available timestamp per symbol on landed data (map-side partial min, tiny shuffle)."""
    return candles.groupBy(key).agg(F.min(ts).alias("first_ts"))


def symbol_records(universe: DataFrame, first: DataFrame | None = None,
                   fallback: str = S.LISTING_FALLBACK_METADATA) -> DataFrame:
    """Metadata records (curated names) with the listing timestamp text, falling back when unknown."""
    base = universe.select(
        "symbol", "status", F.col("baseAsset").alias("base_asset"),
        F.col("baseAssetPrecision").alias("base_precision"), F.col("quoteAsset").alias("quote_asset"),
        F.col("quotePrecision").alias("quote_precision"))
    if first is None:
        return base.withColumn("tracking_start_ts", F.lit(fallback))
    return (base.join(first, "symbol", "left")
                .withColumn("tracking_start_ts",
                            F.coalesce(F.date_format("first_ts", "yyyy-MM-dd HH:mm:ss"), F.lit(fallback)))
                .drop("first_ts"))
