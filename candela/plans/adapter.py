"""Driver tables -> candle inputs, as plain DataFrame steps.

``events`` is read as a tick table: symbol = event_type, price = value, trade size = ``$.k`` of
props + 1, taker side = even event_id. Ticks become 1-minute bars, and bars become the raw
inputs of the pipeline: versions (final, later correction, earlier in-progress), rendered as
live JSON messages (even minutes) or archive CSV lines (odd minutes), with faults injected by
fixed rules on the minute index so every quarantine route is exercised. All of it is derived
from the table, so the work grows with it; nothing is sampled or dropped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from candela import schemas as S
from candela.functions.columns import minute_index
from candela.operators.bronze import unify
from candela.sources.archives import archive_path, parse_csv_lines
from candela.sources.messages import parse_messages

# Fault and version rules on the minute index m (fixed values of the test plan).
FAULT_NEGATIVE_CLOSE = 97
FAULT_NULL_OPEN_TIME = 101
FAULT_NULL_SYMBOL = 103
FAULT_NULL_CLOSE = 107
FAULT_BAD_HIGH_TEXT = 109
FAULT_OVERFLOW_VOLUME = 113
DRIFT_EXTRA_FIELD = 89
VERSION_CORRECTION = 5
VERSION_IN_PROGRESS = 7
MICROS_SYMBOL = "click"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ticks(events: DataFrame) -> DataFrame:
    size = (F.get_json_object("props", "$.k").try_cast("int") + 1).cast(S.PRICE)
    return events.select(
        F.col("event_type").alias("symbol"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("event_id"),
        F.col("value").cast(S.PRICE).alias("price"),
        size.alias("size"),
    )


def bars(events: DataFrame) -> DataFrame:
    """1-minute OHLCV bars per symbol: one shuffle on (symbol, minute) with partial aggregation."""
    # one number orders by (ts, event_id), so ties are settled and the hash aggregate stays
    number = lambda c, digits: c.cast(f"decimal({digits},0)")
    t = ticks(events).withColumn("at", number(F.unix_micros("ts"), 18) * number(F.lit("1" + "0" * 19), 20) + number(F.col("event_id"), 19))
    taker = F.when(F.col("event_id") % 2 == 0, F.col("size")).otherwise(F.lit(0))
    d = lambda c: c.cast(S.PRICE)
    return (t.groupBy("symbol", F.date_trunc("minute", "ts").alias("open_time_ts"))
             .agg(F.min_by("price", "at").alias("open"), F.max("price").alias("high"),
                  F.min("price").alias("low"), F.max_by("price", "at").alias("close"),
                  d(F.sum("size")).alias("volume"),
                  d(F.sum(F.col("price") * F.col("size"))).alias("quote_asset_volume"),
                  F.count(F.lit(1)).cast("int").alias("number_of_trades"),
                  d(F.sum(taker)).alias("taker_buy_base_vol"),
                  d(F.sum(taker * F.col("price"))).alias("taker_buy_quote_vol")))


def versions(b: DataFrame) -> DataFrame:
    """Every bar once as the final candle (arrives 61 s after the open); bars on minutes
    divisible by 5 again as a correction (close + 1, 30 minutes later); bars on minutes divisible
    by 7 also as an earlier in-progress candle (30 s after the open, close = open, one trade)."""
    m = minute_index("open_time_ts")
    b = b.withColumn("m", m)
    at = lambda secs: F.timestamp_seconds(F.unix_seconds("open_time_ts") + secs)
    base = b.withColumns({"is_final": F.lit(True), "ingestion_timestamp": at(61), "version": F.lit("final"),
                          "route": F.when(F.col("m") % 2 == 0, "stream").otherwise("archive")})
    corr = (b.filter(F.col("m") % VERSION_CORRECTION == 0)
             .withColumns({"close": (F.col("close") + 1).cast(S.PRICE), "is_final": F.lit(True),
                           "ingestion_timestamp": at(1800), "version": F.lit("correction"),
                           "route": F.lit("archive")}))
    early = (b.filter(F.col("m") % VERSION_IN_PROGRESS == 0)
              .withColumns({"close": F.col("open"), "number_of_trades": F.lit(1), "is_final": F.lit(False),
                            "ingestion_timestamp": at(30), "version": F.lit("in_progress"),
                            "route": F.lit("stream")}))
    return base.unionByName(early).unionByName(corr)


def _text(c: str) -> Column:
    return F.col(c).cast("string")


def raw(v: DataFrame) -> DataFrame:
    """Render versions as source text with the fault rules applied (epochs in ms; the micro
    symbol in µs, so both epoch branches run)."""
    m = F.col("m")
    us = F.col("symbol") == MICROS_SYMBOL
    open_epoch = F.when(us, F.unix_micros("open_time_ts")).otherwise(F.unix_millis("open_time_ts"))
    close_epoch = open_epoch + F.when(us, F.lit(59_999_999)).otherwise(F.lit(59_999))
    close_txt = (F.when(m % FAULT_NULL_CLOSE == 0, F.lit(None).cast("string"))
                  .when(m % FAULT_NEGATIVE_CLOSE == 0, F.concat(F.lit("-"), _text("close")))
                  .otherwise(_text("close")))
    return v.select(
        F.when(m % FAULT_NULL_SYMBOL != 0, F.col("symbol")).alias("symbol"),
        F.when(m % FAULT_NULL_OPEN_TIME != 0, open_epoch).alias("open_time"),
        close_epoch.alias("close_time"),
        _text("open").alias("open"),
        F.when(m % FAULT_BAD_HIGH_TEXT == 0, F.lit("abc")).otherwise(_text("high")).alias("high"),
        _text("low").alias("low"),
        close_txt.alias("close"),
        F.when(m % FAULT_OVERFLOW_VOLUME == 0, F.lit("100000000000")).otherwise(_text("volume")).alias("volume"),
        F.col("number_of_trades"),
        _text("quote_asset_volume").alias("quote_asset_volume"),
        _text("taker_buy_base_vol").alias("taker_buy_base_vol"),
        _text("taker_buy_quote_vol").alias("taker_buy_quote_vol"),
        "is_final", "ingestion_timestamp", "route", "version", "m", "open_time_ts",
    )


def messages(r: DataFrame, *keep: str) -> DataFrame:
    """Live route as JSON message text (minutes divisible by 89 carry an unknown field)."""
    k = [F.col(long).alias(short) for short, long, _ in S.MESSAGE_FIELDS]
    drift = F.col("m") % DRIFT_EXTRA_FIELD == 0
    # A NULL field is left out of the JSON text, so only drifting messages carry "Z".
    candle = F.struct(*k, F.when(drift, F.lit("1")).alias("Z"))
    return (r.filter(F.col("route") == "stream")
             .select(F.to_json(F.struct(F.lit("kline").alias("e"), F.col("symbol").alias("s"),
                                        candle.alias("k"))).alias("value"),
                     "ingestion_timestamp", *keep))


def csv_lines(r: DataFrame, *keep: str) -> DataFrame:
    """Archive route as CSV lines with their landing path (minutes divisible by 89 carry a 13th field)."""
    fields = [F.coalesce(F.col(n).cast("string"), F.lit("")) for n, _ in S.CSV_COLUMNS if n != "ignore"]
    fields.append(F.lit("0"))
    line = F.concat_ws(",", *fields)
    line = F.when(F.col("m") % DRIFT_EXTRA_FIELD == 0, F.concat(line, F.lit(",x"))).otherwise(line)
    return (r.filter(F.col("route") == "archive")
             .select(line.alias("line"),
                     archive_path(F.col("symbol"), F.year("open_time_ts"), F.month("open_time_ts")).alias("path"),
                     "ingestion_timestamp", *keep))


def bronze_from_events(events: DataFrame, bar_rows: DataFrame | None = None) -> DataFrame:
    """Both routes parsed by the real source parsers and unified (ingestion time = arrival rule).
    ``bar_rows`` may be a stored copy of ``bars(events)``."""
    r = raw(versions(bar_rows if bar_rows is not None else bars(events)))
    live = parse_messages(messages(r), "value", F.col("ingestion_timestamp"))
    arch = parse_csv_lines(csv_lines(r), "line", "path", F.col("ingestion_timestamp"))
    return unify(live, arch)


def exchange_listing(events: DataFrame, orders: DataFrame) -> DataFrame:
    """An exchange listing (exchange field names) derived from the tables: every event type is a
    trading symbol quoted in the universe's quote asset; every order priority is listed too, trading
    when its leading digit is at most 3 and quoted in BTC when that digit is 3. So the universe
    filter keeps some and drops others, and two tradable symbols have no candles at all."""
    ev = (events.select(F.col("event_type").alias("symbol")).distinct()
                .select("symbol", F.lit(S.UNIVERSE_STATUS).alias("status"), F.upper("symbol").alias("baseAsset"),
                        F.lit(S.UNIVERSE_QUOTE_ASSET).alias("quoteAsset")))
    digit = F.substring("symbol", 1, 1)
    od = (orders.select(F.col("o_orderpriority").alias("symbol")).distinct()
                .select("symbol", F.when(digit <= "3", F.lit(S.UNIVERSE_STATUS)).otherwise(F.lit("HALT")).alias("status"),
                        F.upper(F.regexp_replace("symbol", "^[0-9]-", "")).alias("baseAsset"),
                        F.when(digit == "3", F.lit("BTC")).otherwise(F.lit(S.UNIVERSE_QUOTE_ASSET)).alias("quoteAsset")))
    return (ev.unionByName(od)
              .withColumns({"baseAssetPrecision": F.lit(8).cast("long"), "quotePrecision": F.lit(8).cast("long")}))


def symbol_records_from_tables(events: DataFrame, orders: DataFrame) -> DataFrame:
    """Universe filter over the derived listing, listing time = first tick (fallback when none)."""
    from candela.operators.universe import first_seen, symbol_records, tradable
    t = ticks(events)
    return symbol_records(tradable(exchange_listing(events, orders)), first_seen(t, "symbol", "ts"))
