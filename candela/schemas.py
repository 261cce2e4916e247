"""Explicit schemas and the fixed values results depend on."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType, BooleanType, DecimalType, IntegerType, LongType, StringType, StructField, StructType,
)

PRICE = DecimalType(18, 8)

# ---------------------------------------------------------------------------------------------
# Fixed values. These must stay exactly as written for results to be right.
#
# Archive CSV: no header, twelve columns in this order.
CSV_COLUMNS = [
    ("open_time", "long"), ("open", "string"), ("high", "string"), ("low", "string"),
    ("close", "string"), ("volume", "string"), ("close_time", "long"),
    ("quote_asset_volume", "string"), ("number_of_trades", "int"),
    ("taker_buy_base_vol", "string"), ("taker_buy_quote_vol", "string"), ("ignore", "string"),
]
# Live message: top-level "s" is the symbol, "k" holds the candle. Field names are case-sensitive.
MESSAGE_FIELDS = [
    ("t", "open_time", "long"), ("T", "close_time", "long"),
    ("o", "open", "string"), ("h", "high", "string"), ("l", "low", "string"), ("c", "close", "string"),
    ("v", "volume", "string"), ("n", "number_of_trades", "int"), ("q", "quote_asset_volume", "string"),
    ("V", "taker_buy_base_vol", "string"), ("Q", "taker_buy_quote_vol", "string"), ("x", "is_final", "boolean"),
]
# Folder of the landing layout that names the symbol.
SYMBOL_FROM_PATH = r"symbol=([^/]+)"
# Epoch values above this are microseconds, otherwise milliseconds.
EPOCH_MICROS_ABOVE = 9999999999999
# Data-quality rules, in evaluation order (the first failing one names the quarantine reason).
KLINE_RULES = [
    ("valid_price", "close > 0 AND high >= low"),
    ("valid_timestamp", "open_time_ts IS NOT NULL AND open_time_ts > '2017-08-01'"),
    ("valid_symbol", "symbol IS NOT NULL"),
]
# Fact expectations: any violation aborts the write.
FACT_EXPECTATIONS = [
    ("valid_symbol_key", "symbol_id IS NOT NULL"),
    ("valid_time_key", "timestamp_key IS NOT NULL"),
]
# Stream deduplication lateness bound on the candle open time.
DEDUP_WATERMARK = "10 minutes"
# Hourly finalisation delay for the streaming rollup.
HOURLY_FINAL_DELAY = "5 minutes"
# Time dimension span, inclusive, one-minute step.
DIM_TIME_START = "2017-08-01 00:00:00"
DIM_TIME_END = "2027-01-01 00:00:00"
# Trading session by UTC hour: 0-7 Asia, 8-15 Europe, otherwise US. Weekend = dayofweek 1 or 7.
SESSIONS = [("Asia", 0, 7), ("Europe", 8, 15)]
SESSION_OTHER = "US"
WEEKEND_DAYS = [1, 7]
# Gap report look-back in days (7 x 1440 = 10,080 minutes).
GAP_LOOKBACK_DAYS = 7
# Monitors: name, source table, predicate column, look-back, threshold (fires when count > it), severity.
MONITORS = [
    ("schema_drift", "bronze", "15 minutes", 0, "CRITICAL"),
    ("quarantine", "quarantine", "1 hour", 5, "WARNING"),
    ("missing_minutes", "gaps", "1 hour", 0, "WARNING"),
]
# Tradable universe: quote asset and status a listed symbol must have.
UNIVERSE_QUOTE_ASSET = "USDT"
UNIVERSE_STATUS = "TRADING"
# Listing date when none is known: metadata sync falls back to the first, archive backfill to the second.
LISTING_FALLBACK_METADATA = "2017-01-01 00:00:00"
LISTING_FALLBACK_BACKFILL = "2017-08-01"
# Backfill outcome classes.
STATUS_SUCCESS, STATUS_SKIPPED, STATUS_NOT_FOUND, STATUS_FAILED = "SUCCESS", "SKIPPED", "NOT_FOUND", "FAILED"
# Stream read cap per trigger.
MAX_OFFSETS_PER_TRIGGER = 10000
# ---------------------------------------------------------------------------------------------

SOURCE_ARCHIVE = "spot_archive_rest"
SOURCE_STREAM = "spot_live_websocket"
STREAM_SOURCE_FILE = "message_stream"
RESCUE_COLUMN = "_rescued_data"

_T = {"long": LongType(), "string": StringType(), "int": IntegerType(), "boolean": BooleanType()}

# The CSV schema carries the rescue column so PERMISSIVE parsing keeps misfit lines whole.
CSV_SCHEMA = StructType([StructField(n, _T[t], True) for n, t in CSV_COLUMNS]
                        + [StructField(RESCUE_COLUMN, StringType(), True)])
CSV_SCHEMA_DDL = ", ".join(f"`{n}` {t}" for n, t in CSV_COLUMNS) + f", `{RESCUE_COLUMN}` string"

MESSAGE_SCHEMA = StructType([
    StructField("s", StringType(), True),
    StructField("k", StructType([StructField(short, _T[t], True) for short, _, t in MESSAGE_FIELDS]), True),
])

SYMBOL_RECORD = StructType([
    StructField("symbol", StringType(), True),
    StructField("status", StringType(), True),
    StructField("base_asset", StringType(), True),
    StructField("base_precision", LongType(), True),
    StructField("quote_asset", StringType(), True),
    StructField("quote_precision", LongType(), True),
    StructField("tracking_start_ts", StringType(), True),
])
METADATA_SCHEMA = StructType([StructField("symbols", ArrayType(SYMBOL_RECORD), True)])

EXCHANGE_RECORD = StructType([
    StructField("symbol", StringType(), True),
    StructField("status", StringType(), True),
    StructField("baseAsset", StringType(), True),
    StructField("baseAssetPrecision", LongType(), True),
    StructField("quoteAsset", StringType(), True),
    StructField("quotePrecision", LongType(), True),
])
EXCHANGE_SCHEMA = StructType([StructField("symbols", ArrayType(EXCHANGE_RECORD), True)])

# Bronze columns in table order (both sources are unioned by name into this shape).
BRONZE_COLUMNS = [
    "symbol", "open_time", "close_time", "open", "high", "low", "close", "volume", "number_of_trades",
    "quote_asset_volume", "taker_buy_base_vol", "taker_buy_quote_vol", "is_final",
    "ingestion_timestamp", "source_system", "source_file", "raw_payload", RESCUE_COLUMN,
]
PRICE_COLUMNS = ["open", "high", "low", "close", "volume", "quote_asset_volume",
                 "taker_buy_base_vol", "taker_buy_quote_vol"]
