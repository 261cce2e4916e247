"""Fact table: one final candle per symbol and minute, keyed to the symbol dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candela import schemas as S
from candela.operators.dedup import first_arrival, first_arrival_stream
from candela.operators.expectations import expect_or_fail

FACT_MEASURES = ["open", "high", "low", "close", "volume", "quote_asset_volume", "number_of_trades",
                 "taker_buy_base_vol", "taker_buy_quote_vol", "price_range", "price_change",
                 "price_change_pct", "buy_sell_ratio"]
FACT_COLUMNS = ["symbol_id", "timestamp_key", *FACT_MEASURES, "ingestion_timestamp", "source_system"]


def final_candles(valid: DataFrame) -> DataFrame:
    """Final candles only (NULL flag counts as not final), first arrival per (symbol, minute)."""
    finals = valid.filter(F.col("is_final"))
    return first_arrival_stream(finals) if finals.isStreaming else first_arrival(finals)


def to_fact(candles: DataFrame, dim_symbol: DataFrame, processed_ts: bool = False) -> DataFrame:
    """Attach symbol_id (left join; the planner broadcasts a small dimension) and project the fact.

    The expectations then make an unknown symbol or a missing minute abort the job, so the left
    join behaves as an inner join that refuses to drop rows silently.
    """
    dim = dim_symbol.select("symbol", "symbol_id")
    joined = candles.join(dim, on="symbol", how="left")
    audit = [F.current_timestamp().alias("gold_processed_ts")] if processed_ts else []
    fact = joined.select(F.col("symbol_id"), F.col("open_time_ts").alias("timestamp_key"),
                         *FACT_MEASURES, "ingestion_timestamp", "source_system", *audit)
    return expect_or_fail(fact, S.FACT_EXPECTATIONS)


def fact_klines(candles: DataFrame, dim_symbol: DataFrame, processed_ts: bool = False) -> DataFrame:
    """Fact from valid staged candles (as the original: corrections reach the clean table but not
    the fact) or, passing the upserted clean table, from the current version of each candle."""
    return to_fact(final_candles(candles), dim_symbol, processed_ts)
