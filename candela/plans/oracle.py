"""DuckDB SQL oracles: for each registered query, an independent SQL statement over the same
parquet tables. The candle inputs are rebuilt directly from ``events`` (no JSON/CSV round trip),
so the Spark parsers, casts and routing are checked against plain arithmetic."""

from __future__ import annotations

from candela.plans.sqlfrag import pct, ratio, ratio_q

ARCHIVE, STREAM = "spot_archive_rest", "spot_live_websocket"

ADAPTER = f"""
ticks AS (
  SELECT event_type AS symbol, ts, event_id,
         CAST(value AS DECIMAL(18,8)) AS price,
         CAST(TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) + 1 AS DECIMAL(18,8)) AS size
  FROM events),
bars AS (
  SELECT symbol, date_trunc('minute', ts) AS open_time_ts,
         first(price ORDER BY ts, event_id) AS open, max(price) AS high, min(price) AS low, last(price ORDER BY ts, event_id) AS close,
         CAST(sum(size) AS DECIMAL(18,8)) AS volume,
         CAST(sum(CAST(price AS DECIMAL(38,8)) * size) AS DECIMAL(18,8)) AS quote_asset_volume,
         CAST(count(*) AS INTEGER) AS number_of_trades,
         CAST(sum(CASE WHEN event_id % 2 = 0 THEN size ELSE 0 END) AS DECIMAL(18,8)) AS taker_buy_base_vol,
         CAST(sum(CASE WHEN event_id % 2 = 0 THEN CAST(size AS DECIMAL(38,8)) * price ELSE 0 END) AS DECIMAL(18,8)) AS taker_buy_quote_vol
  FROM ticks GROUP BY 1, 2),
bars_m AS (SELECT *, epoch_ms(open_time_ts) // 60000 AS m FROM bars),
versions AS (
  SELECT symbol, open_time_ts, m, open, high, low, close, volume, quote_asset_volume, number_of_trades,
         taker_buy_base_vol, taker_buy_quote_vol, TRUE AS is_final,
         open_time_ts + INTERVAL 61 SECOND AS ingestion_timestamp, 'final' AS version,
         CASE WHEN m % 2 = 0 THEN 'stream' ELSE 'archive' END AS route
  FROM bars_m
  UNION ALL
  SELECT symbol, open_time_ts, m, open, high, low, open, volume, quote_asset_volume, 1,
         taker_buy_base_vol, taker_buy_quote_vol, FALSE,
         open_time_ts + INTERVAL 30 SECOND, 'in_progress', 'stream'
  FROM bars_m WHERE m % 7 = 0
  UNION ALL
  SELECT symbol, open_time_ts, m, open, high, low, CAST(close + 1 AS DECIMAL(18,8)), volume, quote_asset_volume,
         number_of_trades, taker_buy_base_vol, taker_buy_quote_vol, TRUE,
         open_time_ts + INTERVAL 1800 SECOND, 'correction', 'archive'
  FROM bars_m WHERE m % 5 = 0),
staged0 AS (
  SELECT CASE WHEN m % 103 <> 0 THEN symbol END AS symbol,
         CASE WHEN m % 101 <> 0 THEN (CASE WHEN symbol = 'click' THEN epoch_us(open_time_ts) ELSE epoch_ms(open_time_ts) END) END AS open_time,
         CASE WHEN symbol = 'click' THEN epoch_us(open_time_ts) + 59999999 ELSE epoch_ms(open_time_ts) + 59999 END AS close_time,
         open,
         CASE WHEN m % 109 <> 0 THEN high END AS high,
         low,
         CAST(CASE WHEN m % 107 = 0 THEN NULL WHEN m % 97 = 0 THEN -close ELSE close END AS DECIMAL(18,8)) AS close,
         CASE WHEN m % 113 <> 0 THEN volume END AS volume,
         number_of_trades, quote_asset_volume, taker_buy_base_vol, taker_buy_quote_vol,
         is_final, ingestion_timestamp,
         CASE WHEN route = 'stream' THEN '{STREAM}' ELSE '{ARCHIVE}' END AS source_system,
         CASE WHEN route = 'stream' THEN 'message_stream'
              ELSE printf('raw_klines/symbol=%s/year=%d/month=%02d.csv',
                          coalesce(CASE WHEN m % 103 <> 0 THEN symbol END, ''),
                          year(open_time_ts), month(open_time_ts)) END AS source_file,
         CASE WHEN m % 101 <> 0 THEN open_time_ts END AS open_time_ts,
         open_time_ts + CASE WHEN symbol = 'click' THEN INTERVAL 59999999 MICROSECOND ELSE INTERVAL 59999 MILLISECOND END AS close_time_ts,
         m % 89 = 0 AS rescued, route, version, m, close AS v_close, volume AS v_volume, open_time_ts AS v_ts
  FROM versions),
staged AS (
  SELECT *, CAST(high - low AS DECIMAL(19,8)) AS price_range,
         CAST(close - open AS DECIMAL(19,8)) AS price_change,
         CASE WHEN open <> 0 THEN {pct("close - open", "open")} END AS price_change_pct,
         CASE WHEN volume > 0 THEN {ratio("taker_buy_base_vol", "volume", 20)} END AS buy_sell_ratio
  FROM staged0),
tagged AS (
  SELECT *, coalesce(close > 0 AND high >= low, FALSE) AS r_price,
         coalesce(open_time_ts IS NOT NULL AND open_time_ts > TIMESTAMP '2017-08-01', FALSE) AS r_ts,
         coalesce(symbol IS NOT NULL, FALSE) AS r_sym
  FROM staged),
valid AS (SELECT * FROM tagged WHERE r_price AND r_ts AND r_sym),
quarantine AS (
  SELECT *, CASE WHEN NOT r_price THEN 'valid_price' WHEN NOT r_ts THEN 'valid_timestamp'
                 WHEN NOT r_sym THEN 'valid_symbol' END AS failed_rule,
         concat_ws(',', CASE WHEN NOT r_price THEN 'valid_price' END, CASE WHEN NOT r_ts THEN 'valid_timestamp' END,
                   CASE WHEN NOT r_sym THEN 'valid_symbol' END) AS failed_rules
  FROM tagged WHERE NOT (r_price AND r_ts AND r_sym)),
listing AS (
  SELECT DISTINCT event_type AS symbol, 'TRADING' AS status, upper(event_type) AS base_asset, 'USDT' AS quote_asset
  FROM events
  UNION ALL
  SELECT DISTINCT o_orderpriority,
         CASE WHEN substr(o_orderpriority, 1, 1) <= '3' THEN 'TRADING' ELSE 'HALT' END,
         upper(regexp_replace(o_orderpriority, '^[0-9]-', '')),
         CASE WHEN substr(o_orderpriority, 1, 1) = '3' THEN 'BTC' ELSE 'USDT' END
  FROM orders),
universe AS (SELECT * FROM listing WHERE quote_asset = 'USDT' AND status = 'TRADING'),
first_seen AS (SELECT event_type AS symbol, min(ts) AS first_ts FROM events GROUP BY 1),
dim AS (
  SELECT u.symbol, u.status, u.base_asset, CAST(8 AS BIGINT) AS base_precision, u.quote_asset,
         CAST(8 AS BIGINT) AS quote_precision,
         coalesce(strftime(f.first_ts, '%Y-%m-%d %H:%M:%S'), '2017-01-01 00:00:00') AS tracking_start_ts,
         CAST(row_number() OVER (ORDER BY u.symbol) AS INTEGER) AS symbol_id
  FROM universe u LEFT JOIN first_seen f USING (symbol)),
finals AS (
  SELECT *, row_number() OVER (PARTITION BY symbol, open_time_ts ORDER BY ingestion_timestamp, source_system) AS rn
  FROM valid WHERE is_final),
fact AS (
  SELECT d.symbol_id, f.open_time_ts AS timestamp_key, open, high, low, close, volume, quote_asset_volume,
         number_of_trades, taker_buy_base_vol, taker_buy_quote_vol, price_range, price_change,
         price_change_pct, buy_sell_ratio, ingestion_timestamp, source_system
  FROM finals f LEFT JOIN dim d USING (symbol) WHERE rn = 1)
"""

STAGED_COLS = """symbol, open_time, close_time, open, high, low, close, volume, number_of_trades, quote_asset_volume,
  taker_buy_base_vol, taker_buy_quote_vol, is_final, ingestion_timestamp, source_system, source_file,
  open_time_ts, close_time_ts, price_range, price_change, price_change_pct, buy_sell_ratio"""


def with_adapter(body: str) -> str:
    return f"WITH {ADAPTER.strip()}\n{body}"


def rollup_sql(source: str, key: str, bucket_expr: str, bucket_name: str) -> str:
    return f"""
, r0 AS (
  SELECT {key}, {bucket_expr} AS {bucket_name},
         arg_min(open, timestamp_key) AS open, max(high) AS high, min(low) AS low,
         arg_max(close, timestamp_key) AS close,
         CAST(sum(volume) AS DECIMAL(28,8)) AS total_base_volume,
         CAST(sum(quote_asset_volume) AS DECIMAL(28,8)) AS total_quote_volume,
         CAST(sum(number_of_trades) AS BIGINT) AS total_trades,
         CAST(sum(taker_buy_base_vol) AS DECIMAL(28,8)) AS taker_buy_volume
  FROM {source} GROUP BY 1, 2)
SELECT {key}, {bucket_name}, open, high, low, close, total_base_volume, total_trades,
       {ratio("total_quote_volume", "total_base_volume", 10)} AS vwap,
       {ratio("high - low", "open", 19)} AS amplitude_pct,
       {ratio("taker_buy_volume", "total_base_volume", 10)} AS buy_pressure_ratio
FROM r0"""


def oracles() -> dict[str, str]:
    q: dict[str, str] = {}
    q["bars_1m"] = with_adapter("SELECT * FROM bars")
    q["staged"] = with_adapter(f"SELECT {STAGED_COLS} FROM staged")
    q["rules_valid"] = with_adapter(f"SELECT {STAGED_COLS} FROM valid")
    q["rules_quarantine"] = with_adapter(f"SELECT {STAGED_COLS}, failed_rule, failed_rules FROM quarantine")
    q["rules_summary"] = with_adapter(
        "SELECT failed_rule, count(*) AS n_rows FROM quarantine GROUP BY failed_rule")
    q["dim_symbol"] = with_adapter("SELECT * FROM dim")
    q["fact_bars"] = with_adapter("SELECT * FROM fact")
    q["rollup_hourly"] = with_adapter(rollup_sql("fact", "symbol_id", "date_trunc('hour', timestamp_key)", "hour_start"))
    q["rollup_daily"] = with_adapter(rollup_sql("fact", "symbol_id", "CAST(timestamp_key AS DATE)", "date"))
    q.update(more_oracles())
    # Streams end equal to their batch forms; the hourly stream holds back hours whose end plus
    # the 5-minute delay is past the last event time seen.
    q["gap_report_sparse"] = q["gap_report"]
    q["stream_scd1"] = q["upsert_scd1"]
    q["stream_fact"] = q["fact_bars"]
    q["stream_hourly_final"] = (q["rollup_hourly"] +
        "\nWHERE hour_start + INTERVAL 65 MINUTE <= (SELECT max(timestamp_key) FROM fact)")
    q["stream_daily_final"] = (q["rollup_daily"] +
        "\nWHERE date + INTERVAL 1445 MINUTE <= (SELECT max(timestamp_key) FROM fact)")
    q["stream_quarantine"] = q["rules_quarantine"]
    q["stream_fact_new_symbol"] = f"SELECT d.symbol, f.* EXCLUDE (symbol_id) FROM ({q['fact_bars']}) f JOIN ({q['dim_symbol']}) d USING (symbol_id)"
    from candela.plans import landing_oracle
    return q | landing_oracle.oracles()


BRONZE_COLS = """symbol, open_time, close_time,
  CAST(open AS VARCHAR) AS open,
  CASE WHEN m % 109 = 0 THEN 'abc' ELSE CAST(high AS VARCHAR) END AS high,
  CAST(low AS VARCHAR) AS low,
  CASE WHEN m % 107 = 0 THEN NULL WHEN m % 97 = 0 THEN '-' || CAST(v_close AS VARCHAR) ELSE CAST(v_close AS VARCHAR) END AS close,
  CASE WHEN m % 113 = 0 THEN '100000000000' ELSE CAST(v_volume AS VARCHAR) END AS volume,
  number_of_trades, CAST(quote_asset_volume AS VARCHAR) AS quote_asset_volume,
  CAST(taker_buy_base_vol AS VARCHAR) AS taker_buy_base_vol, CAST(taker_buy_quote_vol AS VARCHAR) AS taker_buy_quote_vol,
  is_final, ingestion_timestamp, source_system, source_file, rescued"""

MISSING = """
, b AS (SELECT max(ts) AS now, CAST(CAST(max(ts) AS DATE) AS TIMESTAMP) AS d,
               CASE WHEN date_trunc('minute', max(ts)) = max(ts) THEN max(ts)
                    ELSE date_trunc('minute', max(ts)) + INTERVAL 1 MINUTE END AS e FROM events)
, expected AS (
  SELECT dim.symbol_id, dim.symbol, unnest(generate_series({start}, {end} - INTERVAL 1 MINUTE, INTERVAL 1 MINUTE)) AS minute
  FROM dim, b)
, missing AS (
  SELECT e.symbol, e.minute AS missing_minute FROM expected e
  WHERE NOT EXISTS (SELECT 1 FROM fact f WHERE f.symbol_id = e.symbol_id AND f.timestamp_key = e.minute))
"""
MISSING_PARITY = MISSING.format(start="b.d - INTERVAL 7 DAY", end="b.d")
MISSING_TODAY = MISSING.format(start="b.e - INTERVAL 7 DAY", end="b.e")

DAILY = """
, daily AS (
  SELECT symbol_id, CAST(timestamp_key AS DATE) AS date,
         arg_min(open, timestamp_key) AS open, max(high) AS high, min(low) AS low,
         arg_max(close, timestamp_key) AS close,
         CAST(sum(volume) AS DECIMAL(28,8)) AS total_base_volume,
         CAST(sum(quote_asset_volume) AS DECIMAL(28,8)) AS total_quote_volume,
         CAST(sum(number_of_trades) AS BIGINT) AS total_trades,
         CAST(sum(taker_buy_base_vol) AS DECIMAL(28,8)) AS taker_buy_volume
  FROM fact GROUP BY 1, 2)
"""

HOURLY = DAILY.replace("CAST(timestamp_key AS DATE) AS date", "date_trunc('hour', timestamp_key) AS hour_start").replace(
    "daily AS", "hourly AS")

ORDERS_CAL = """
WITH l AS (SELECT o_orderpriority AS symbol, date_trunc('month', min(o_orderdate)) AS start FROM orders GROUP BY 1),
b AS (SELECT date_trunc('month', max(o_orderdate)) - INTERVAL 1 MONTH AS stop FROM orders),
ex AS (SELECT symbol, unnest(generate_series(start, stop, INTERVAL 1 MONTH)) AS ms FROM l, b WHERE start <= stop),
expected AS (
  SELECT symbol, CAST(year(ms) AS INTEGER) AS year, CAST(month(ms) AS INTEGER) AS month,
         printf('raw_klines/symbol=%s/year=%d/month=%02d.csv', symbol, year(ms), month(ms)) AS path FROM ex),
months AS (SELECT DISTINCT o_orderpriority AS symbol, CAST(year(o_orderdate) AS INTEGER) AS year,
                  CAST(month(o_orderdate) AS INTEGER) AS month FROM orders),
landed AS (SELECT * FROM months WHERE (year * 12 + month) % 7 <> 0)
"""

SESSION = ("CASE WHEN hour(timestamp_key) BETWEEN 0 AND 7 THEN 'Asia' "
           "WHEN hour(timestamp_key) BETWEEN 8 AND 15 THEN 'Europe' ELSE 'US' END")


def more_oracles() -> dict[str, str]:
    q: dict[str, str] = {}
    q["bronze_union"] = with_adapter(f"SELECT {BRONZE_COLS} FROM staged0")
    q["upsert_scd1"] = with_adapter(
        f", ranked AS (SELECT *, row_number() OVER (PARTITION BY symbol, open_time_ts ORDER BY ingestion_timestamp DESC, "
        f"is_final DESC, number_of_trades DESC) AS rk FROM valid) SELECT {STAGED_COLS} FROM ranked WHERE rk = 1")
    q["dedup_first"] = with_adapter(f"SELECT {STAGED_COLS} FROM finals WHERE rn = 1")
    q["universe_filter"] = with_adapter("""
, candidates AS (SELECT symbol FROM listing UNION ALL SELECT n_name FROM nation)
SELECT c.symbol, l.status, l.quote_asset,
       CASE WHEN c.symbol IN (SELECT symbol FROM universe) THEN 'kept' ELSE 'dropped' END AS decision
FROM candidates c LEFT JOIN listing l ON l.symbol = c.symbol""")
    q["dim_time_month"] = """
WITH b AS (SELECT CAST(CAST(min(ts) AS DATE) AS TIMESTAMP) AS d0, CAST(CAST(max(ts) AS DATE) AS TIMESTAMP) AS d1 FROM events),
g AS (SELECT unnest(generate_series(d0, d1 + INTERVAL 1439 MINUTE, INTERVAL 1 MINUTE)) AS timestamp_key FROM b)
SELECT timestamp_key, CAST(year(timestamp_key) AS INTEGER) AS year, CAST(month(timestamp_key) AS INTEGER) AS month,
       CAST(day(timestamp_key) AS INTEGER) AS day, CAST(hour(timestamp_key) AS INTEGER) AS hour,
       CAST(minute(timestamp_key) AS INTEGER) AS minute, CAST(quarter(timestamp_key) AS INTEGER) AS quarter,
       strftime(timestamp_key, '%A') AS day_name, strftime(timestamp_key, '%a') AS day_name_short,
       CAST(dayofweek(timestamp_key) + 1 AS INTEGER) AS day_of_week, dayofweek(timestamp_key) IN (0, 6) AS is_weekend,
       """ + SESSION + """ AS trading_session, CAST(timestamp_key AS DATE) AS date
FROM g"""
    q["rollup_lineitem_daily"] = f"""
WITH src AS (
  SELECT l_partkey, l_shipdate, CAST(l_quantity AS DECIMAL(18,8)) AS volume,
         CAST(l_extendedprice AS DECIMAL(18,8)) AS quote,
         CASE WHEN l_returnflag = 'R' THEN CAST(l_quantity AS DECIMAL(18,8)) ELSE 0 END AS taker
  FROM lineitem),
r0 AS (
  SELECT l_partkey, CAST(l_shipdate AS DATE) AS date, CAST(sum(volume) AS DECIMAL(28,8)) AS total_base_volume,
         CAST(sum(quote) AS DECIMAL(28,8)) AS total_quote_volume, CAST(sum(taker) AS DECIMAL(28,8)) AS taker_buy_volume
  FROM src GROUP BY 1, 2)
SELECT l_partkey, date, total_base_volume,
       {ratio("total_quote_volume", "total_base_volume", 10)} AS vwap,
       {ratio("taker_buy_volume", "total_base_volume", 10)} AS buy_pressure_ratio
FROM r0"""
    q["gap_report"] = with_adapter(MISSING_PARITY + "SELECT * FROM missing")
    q["gap_report_today"] = with_adapter(MISSING_TODAY + "SELECT * FROM missing")
    q["gap_runs"] = with_adapter(MISSING_PARITY + """
, numbered AS (
  SELECT symbol, missing_minute,
         epoch_ms(missing_minute) // 60000 - row_number() OVER (PARTITION BY symbol ORDER BY missing_minute) AS grp
  FROM missing)
SELECT symbol, min(missing_minute) AS run_start, max(missing_minute) AS run_end, count(*) AS n_missing
FROM numbered GROUP BY symbol, grp""")
    q["monitors"] = with_adapter(MISSING_TODAY + """
SELECT 'schema_drift' AS monitor, count(*) AS observed, CAST(0 AS DOUBLE) AS threshold, count(*) > 0 AS triggered,
       'CRITICAL' AS severity, '15 minutes' AS lookback
FROM staged0, b WHERE rescued AND ingestion_timestamp > b.now - INTERVAL 15 MINUTE
UNION ALL
SELECT 'quarantine', count(*), CAST(5 AS DOUBLE), count(*) > 5, 'WARNING', '1 hour'
FROM quarantine, b WHERE ingestion_timestamp > b.now - INTERVAL 1 HOUR
UNION ALL
SELECT 'missing_minutes', count(*), CAST(0 AS DOUBLE), count(*) > 0, 'WARNING', '1 hour'
FROM missing, b WHERE missing_minute > b.now - INTERVAL 1 HOUR""")
    q["backfill_manifest"] = ORDERS_CAL + """
SELECT * FROM expected e
WHERE NOT EXISTS (SELECT 1 FROM landed l WHERE l.symbol = e.symbol AND l.year = e.year AND l.month = e.month)"""
    q["daily_price_action"] = with_adapter(DAILY + f"""
, p AS (SELECT symbol_id, date, open, high, low, close,
               lag(close) OVER (PARTITION BY symbol_id ORDER BY date) AS prev_close FROM daily)
SELECT *, {pct("close - prev_close", "prev_close")} AS daily_change_pct FROM p""")
    q["market_sentiment"] = with_adapter(HOURLY + f"""
SELECT symbol_id, hour_start, total_base_volume,
       {ratio("taker_buy_volume", "total_base_volume", 10)} AS buy_pressure_ratio,
       {ratio("taker_buy_volume - (total_base_volume - taker_buy_volume)", "total_base_volume", 8)} AS buy_sell_imbalance
FROM hourly""")
    q["volatility_rank"] = with_adapter(DAILY + f"""
SELECT symbol_id, date, {ratio("high - low", "open", 19)} AS amplitude_pct,
       CAST(rank() OVER (PARTITION BY date ORDER BY {ratio_q("high - low", "open", 19)} DESC NULLS LAST) AS INTEGER)
         AS volatility_rank
FROM daily""")
    q["volume_analysis"] = with_adapter(DAILY + f"""
SELECT symbol_id, date, total_base_volume, total_quote_volume, taker_buy_volume, total_trades,
       {ratio("total_quote_volume", "total_base_volume", 10)} AS vwap
FROM daily""")
    q["session_breakdown"] = with_adapter(f"""
, s AS (
  SELECT symbol_id, {SESSION} AS trading_session, dayofweek(timestamp_key) IN (0, 6) AS is_weekend,
         count(*) AS n_minutes, CAST(sum(volume) AS DECIMAL(28,8)) AS total_base_volume,
         CAST(sum(quote_asset_volume) AS DECIMAL(28,8)) AS total_quote_volume,
         CAST(sum(number_of_trades) AS BIGINT) AS total_trades
  FROM fact GROUP BY 1, 2, 3)
SELECT *, {ratio("total_quote_volume", "total_base_volume", 10)} AS vwap FROM s""")
    return q
