"""Dashboard queries over the gold tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from candela.functions.columns import null_if_zero, time_part_map
from candela.operators.dims import dim_time
from candela.operators.rollup import rollup


def daily_price_action(daily: DataFrame) -> DataFrame:
    """Daily OHLC with the previous close and the day-on-day change in percent.
    Window per symbol over its days (one row per day, so partitions stay small)."""
    w = Window.partitionBy("symbol_id").orderBy("date")
    prev = F.lag("close").over(w)
    return daily.select("symbol_id", "date", "open", "high", "low", "close", prev.alias("prev_close")).withColumn(
        "daily_change_pct", (F.col("close") - F.col("prev_close")) / null_if_zero("prev_close") * 100)


def market_sentiment(fact: DataFrame, grain: str = "hour") -> DataFrame:
    """Buy pressure and buy/sell imbalance, (taker - (volume - taker)) / volume, per symbol and bucket."""
    r = rollup(fact, grain, ohlc=False, extra_sums=True)
    bucket = "date" if grain == "day" else f"{grain}_start"
    num = F.col("taker_buy_volume") - (F.col("total_base_volume") - F.col("taker_buy_volume"))
    return r.select("symbol_id", bucket, "total_base_volume", "buy_pressure_ratio",
                    (num / null_if_zero("total_base_volume")).alias("buy_sell_imbalance"))


def volatility_rank(daily: DataFrame) -> DataFrame:
    """Daily amplitude with each symbol's rank among all symbols that day (1 = most volatile).
    Partitioned by date: one row per symbol per day."""
    w = Window.partitionBy("date").orderBy(F.col("amplitude_pct").desc_nulls_last())
    return daily.select("symbol_id", "date", "amplitude_pct", F.rank().over(w).alias("volatility_rank"))


def volume_analysis(fact: DataFrame) -> DataFrame:
    """Daily base / quote / taker volumes and VWAP (the sums the daily summary leaves out included)."""
    r = rollup(fact, "day", ohlc=False, extra_sums=True)
    return r.select("symbol_id", "date", "total_base_volume", "total_quote_volume", "taker_buy_volume",
                    "total_trades", "vwap")


def session_breakdown(fact: DataFrame) -> DataFrame:
    """Activity by trading session and weekend flag. The calendar attributes are the time
    dimension's own expressions applied to the fact key, so no join to the 5-million-row
    dimension (and no shuffle of the fact for it) is needed."""
    tp = time_part_map(F.col("timestamp_key"))
    f = fact.select("symbol_id", "volume", "quote_asset_volume", "number_of_trades",
                    tp["trading_session"], tp["is_weekend"])
    return (f.groupBy("symbol_id", "trading_session", "is_weekend")
             .agg(F.count(F.lit(1)).alias("n_minutes"), F.sum("volume").alias("total_base_volume"),
                  F.sum("quote_asset_volume").alias("total_quote_volume"),
                  F.sum("number_of_trades").alias("total_trades"))
             .withColumn("vwap", F.col("total_quote_volume") / null_if_zero("total_base_volume")))


def join_dim_time(fact: DataFrame, dim_time: DataFrame, fact_date: str = "fact_date") -> DataFrame:
    """The star join on (day, minute), for consumers that want every dimension attribute. The day is in the key, so a stored fact
    is pruned to the days of a filtered dimension and a minute of the day is no hot key; the sides are merged in key order, and
    the five-million-row dimension is never broadcast. Every fact row stays; a minute outside of the dimension has NULL attributes."""
    right = dim_time.withColumnRenamed("date", fact_date).hint("merge")
    return fact.join(right, [fact_date, "timestamp_key"], "left")


def dim_time_of(fact: DataFrame, fact_date: str = "fact_date") -> DataFrame:
    """The generated minute dimension over the whole days that the fact has (two dates reach the driver)."""
    b = fact.agg(F.min(fact_date).alias("lo"), F.max(fact_date).alias("hi")).first()
    if b["lo"] is None:
        return dim_time(fact.sparkSession).limit(0)
    return dim_time(fact.sparkSession, f"{b['lo']} 00:00:00", f"{b['hi']} 23:59:00")
