"""Time-bucket rollups of the fact: OHLC, volumes, VWAP, amplitude, buy pressure."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candela.functions.columns import null_if_zero


def bucket_name(grain: str) -> str:
    return "date" if grain == "day" else f"{grain}_start"


def bucket_of(grain: str, ts: str) -> Column:
    """``day`` -> date; ``hour``/``minute``/``week``/``month`` -> truncated timestamp ``<grain>_start``."""
    if grain == "day":
        return F.to_date(ts).alias("date")
    return F.date_trunc(grain, F.col(ts)).alias(bucket_name(grain))


def rollup(fact: DataFrame, grain: str = "hour", key: str = "symbol_id", ts: str = "timestamp_key",
           ohlc: bool = True, extra_sums: bool = False, price_open: str = "open", price_high: str = "high",
           price_low: str = "low", price_close: str = "close", volume: str = "volume",
           quote: str = "quote_asset_volume", trades: str | None = "number_of_trades",
           taker: str = "taker_buy_base_vol") -> DataFrame:
    """Group by (key, bucket) and compute the summary.

    open/close are the first/last price by time (``min_by``/``max_by`` ordered by the plain
    timestamp keep the hash aggregate with map-side partial aggregation). Each group holds one
    symbol-bucket, so a busy symbol spreads over many groups. Ratios divide last, on exact sums,
    and are NULL when the divisor is 0.
    """
    g = fact.groupBy(key, bucket_of(grain, ts)).agg(*sums(ts, ohlc, price_open, price_high, price_low, price_close, volume, quote, trades, taker))
    return g.select(key, bucket_name(grain), *ratios(ohlc, bool(trades)), *(["total_quote_volume", "taker_buy_volume"] if extra_sums else []))


def sums(ts: str = "timestamp_key", ohlc: bool = True, price_open: str = "open", price_high: str = "high", price_low: str = "low",
         price_close: str = "close", volume: str = "volume", quote: str = "quote_asset_volume",
         trades: str | None = "number_of_trades", taker: str = "taker_buy_base_vol") -> list[Column]:
    """The aggregates of a bucket."""
    prices = [F.min_by(price_open, ts).alias("open"), F.max(price_high).alias("high"),
              F.min(price_low).alias("low"), F.max_by(price_close, ts).alias("close")]
    totals = [F.sum(volume).alias("total_base_volume"), F.sum(quote).alias("total_quote_volume"),
              *([F.sum(trades).alias("total_trades")] if trades else []), F.sum(taker).alias("taker_buy_volume")]
    return (prices if ohlc else []) + totals


def ratios(ohlc: bool = True, trades: bool = True) -> list[Column]:
    """The columns of a summary, from a bucket's aggregates."""
    over = lambda a, b: F.col(a) / null_if_zero(b)
    return [*(F.col(c) for c in ("open", "high", "low", "close") if ohlc), F.col("total_base_volume"), *([F.col("total_trades")] if trades else []),
            over("total_quote_volume", "total_base_volume").alias("vwap"),
            *([((F.col("high") - F.col("low")) / null_if_zero("open")).alias("amplitude_pct")] if ohlc else []),
            over("taker_buy_volume", "total_base_volume").alias("buy_pressure_ratio")]


def partials(fact: DataFrame, grain: str = "hour", key: str = "symbol_id", ts: str = "timestamp_key") -> DataFrame:
    """Mergeable sums of a bucket: the aggregates of :func:`rollup` with the bucket's first and last minute."""
    return fact.groupBy(key, bucket_of(grain, ts)).agg(F.min(ts).alias("first_minute"), F.max(ts).alias("last_minute"), *sums(ts))


def merge_partials(fine: DataFrame, grain: str = "day", key: str = "symbol_id") -> DataFrame:
    """Partials of a coarser grain from those of a finer one: opens and closes by the minutes they belong to, the rest by sums. Work
    follows the finer buckets, not the fact."""
    exact = lambda c: F.sum(c).cast(fine.schema[c].dataType).alias(c)  # noqa: E731 - sums of sums keep their type
    return fine.groupBy(key, bucket_of(grain, "first_minute")).agg(
        F.min("first_minute").alias("first_minute"), F.max("last_minute").alias("last_minute"),
        F.min_by("open", "first_minute").alias("open"), F.max("high").alias("high"), F.min("low").alias("low"), F.max_by("close", "last_minute").alias("close"),
        *(exact(c) for c in ("total_base_volume", "total_quote_volume", "total_trades", "taker_buy_volume")))


def summary(partial: DataFrame, grain: str, key: str = "symbol_id") -> DataFrame:
    """The summary's columns from partials."""
    return partial.select(key, bucket_name(grain), *ratios())


def hourly_summary(fact: DataFrame, **kw) -> DataFrame:
    return rollup(fact, "hour", **kw)


def daily_summary(fact: DataFrame, **kw) -> DataFrame:
    return rollup(fact, "day", **kw)
