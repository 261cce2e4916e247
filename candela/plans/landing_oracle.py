"""DuckDB SQL for the queries of ``landing.py``."""

from __future__ import annotations

from candela.plans import oracle as O

LANDED = O.BRONZE_COLS.replace("is_final, ingestion_timestamp, source_system, source_file, rescued", "is_final, source_system, rescued")
_MONTH = "strftime(v_ts, '%Y-%m') AS landed"

#: The refresh before which a row arrives: three equal ranges of days; ``late`` rows come one later.
_CHUNKS = """
, span AS (SELECT min(CAST({ts} AS DATE)) AS lo, max(CAST({ts} AS DATE)) AS hi FROM {rows})
, fed AS (SELECT {rows}.*, least(2, CAST(floor(date_diff('day', lo, CAST({ts} AS DATE)) * 3 / (date_diff('day', lo, hi) + 1)) AS INTEGER)
    + CASE WHEN epoch_ms({ts}) // 60000 % {late} = 0 THEN 1 ELSE 0 END) AS chunk FROM {rows}, span)
"""

_ORDER_STATUS = """
, st AS (
  SELECT CASE WHEN EXISTS (SELECT 1 FROM landed l WHERE l.symbol = e.symbol AND l.year = e.year AND l.month = e.month) THEN 'SKIPPED'
              WHEN (year * 12 + month) % 5 = 0
                OR NOT EXISTS (SELECT 1 FROM months l WHERE l.symbol = e.symbol AND l.year = e.year AND l.month = e.month) THEN 'NOT_FOUND'
              WHEN (year * 12 + month) % 3 = 0 THEN 'FAILED' ELSE 'SUCCESS' END AS status
  FROM expected e)
SELECT status, count(*) AS n_tasks FROM st GROUP BY status"""

_HISTORY = """
, arrivals AS (
  SELECT *, CASE WHEN route = 'archive' THEN date_trunc('day', ingestion_timestamp) + INTERVAL 1445 MINUTE ELSE ingestion_timestamp END AS came FROM tagged)
, first_day AS (SELECT min(CAST(timestamp_key AS DATE))::TIMESTAMP AS d FROM fact)
, last_minute AS (SELECT CASE WHEN date_trunc('minute', max(ts)) = max(ts) THEN max(ts) ELSE date_trunc('minute', max(ts)) + INTERVAL 1 MINUTE END AS e, max(ts) AS now FROM events)
, gone AS (
  SELECT minute FROM dim, first_day, last_minute, unnest(generate_series(d, e - INTERVAL 1 MINUTE, INTERVAL 1 MINUTE)) AS g(minute)
  WHERE NOT EXISTS (SELECT 1 FROM fact f WHERE f.symbol_id = dim.symbol_id AND f.timestamp_key = minute))
, rows AS (
  SELECT 'schema_drift' AS monitor, came AS at, count(*) AS n FROM arrivals WHERE rescued GROUP BY 2
  UNION ALL SELECT 'quarantine', came, count(*) FROM arrivals WHERE NOT (r_price AND r_ts AND r_sym) GROUP BY 2
  UNION ALL SELECT 'missing_minutes', minute, count(*) FROM gone GROUP BY 2)
, instants AS (SELECT unnest(generate_series(d - INTERVAL 1 HOUR, now, INTERVAL 5 MINUTE)) AS as_of FROM first_day, last_minute)
, monitors(monitor, lookback, threshold, severity) AS (VALUES
  ('schema_drift', INTERVAL 15 MINUTE, 0::DOUBLE, 'CRITICAL'), ('quarantine', INTERVAL 1 HOUR, 5::DOUBLE, 'WARNING'), ('missing_minutes', INTERVAL 1 HOUR, 0::DOUBLE, 'WARNING'))
, seen AS (
  SELECT i.as_of, m.monitor, sum(r.n) AS n FROM instants i, monitors m, rows r
  WHERE r.monitor = m.monitor AND r.at <= i.as_of AND r.at > i.as_of - m.lookback GROUP BY 1, 2)
SELECT m.monitor, i.as_of, CAST(coalesce(n, 0) AS BIGINT) AS observed, threshold, severity, coalesce(n, 0) > threshold AS triggered
FROM monitors m CROSS JOIN instants i LEFT JOIN seen s ON s.monitor = m.monitor AND s.as_of = i.as_of"""

_PAYLOAD = """CASE WHEN route = 'stream' THEN '{"e":"kline",' || coalesce('"s":"' || symbol || '",', '') || '"k":{' || concat_ws(',',
  '"t":' || open_time, '"T":' || close_time, '"o":"' || open || '"', '"h":"' || CASE WHEN m % 109 = 0 THEN 'abc' ELSE CAST(high AS VARCHAR) END || '"', '"l":"' || low || '"',
  CASE WHEN m % 107 <> 0 THEN '"c":"' || CASE WHEN m % 97 = 0 THEN '-' || CAST(v_close AS VARCHAR) ELSE CAST(v_close AS VARCHAR) END || '"' END,
  '"v":"' || CASE WHEN m % 113 = 0 THEN '100000000000' ELSE CAST(v_volume AS VARCHAR) END || '"', '"n":' || number_of_trades, '"q":"' || quote_asset_volume || '"',
  '"V":"' || taker_buy_base_vol || '"', '"Q":"' || taker_buy_quote_vol || '"', '"x":' || CASE WHEN is_final THEN 'true' ELSE 'false' END,
  CASE WHEN rescued THEN '"Z":"1"' END) || '}}' END"""


def oracles() -> dict[str, str]:
    a = O.with_adapter
    spaced = LANDED.replace("symbol,", "CASE WHEN m % 3 = 0 THEN symbol || ' perp' ELSE symbol END AS symbol,", 1).replace("rescued", "FALSE AS rescued")
    q = {
        "csv_archives": a(f"SELECT {spaced}, {_MONTH} FROM staged0 WHERE route = 'archive'").replace(
            "is_final, source_system", "TRUE AS is_final, source_system"),
        "stream_bronze_union": a(f"SELECT {LANDED}, CASE WHEN route = 'archive' THEN strftime(v_ts, '%Y-%m') ELSE '' END AS landed FROM staged0"),
        "zip_archives": a(f"SELECT {LANDED}, {_MONTH} FROM staged0").replace("is_final, source_system, rescued", f"TRUE AS is_final, '{O.ARCHIVE}' AS source_system, rescued"),
        "ingest_status": O.ORDERS_CAL + _ORDER_STATUS,
        "metadata_document": a("SELECT symbol_id - 1 AS position, * EXCLUDE (symbol_id) FROM dim"),
        "star_join": a(f"""SELECT symbol_id, timestamp_key, close, volume, CAST(timestamp_key AS DATE) AS date, CAST(year(timestamp_key) AS INTEGER) AS year,
  CAST(quarter(timestamp_key) AS INTEGER) AS quarter, CAST(month(timestamp_key) AS INTEGER) AS month, CAST(day(timestamp_key) AS INTEGER) AS day,
  CAST(hour(timestamp_key) AS INTEGER) AS hour, CAST(minute(timestamp_key) AS INTEGER) AS minute, strftime(timestamp_key, '%A') AS day_name,
  CAST(dayofweek(timestamp_key) + 1 AS INTEGER) AS day_of_week, dayofweek(timestamp_key) IN (0, 6) AS is_weekend, {O.SESSION} AS trading_session FROM fact"""),
        "monitor_history": a(_HISTORY),
        "expectation_counts": a("""
, keyed AS (
  SELECT 'all' AS candles, d.symbol_id, open_time_ts FROM staged s LEFT JOIN dim d ON s.symbol = d.symbol WHERE is_final
  UNION ALL SELECT 'valid', d.symbol_id, open_time_ts FROM valid s LEFT JOIN dim d ON s.symbol = d.symbol WHERE is_final)
, counted AS (SELECT candles, count(*) AS n, count(*) FILTER (symbol_id IS NULL) AS bad_symbol, count(*) FILTER (open_time_ts IS NULL) AS bad_time FROM keyed GROUP BY 1)
SELECT candles, 'valid_symbol_key' AS expectation, n AS n_rows, bad_symbol AS n_violations, bad_symbol + bad_time = 0 AS published FROM counted
UNION ALL SELECT candles, 'valid_time_key', n, bad_time, bad_symbol + bad_time = 0 FROM counted"""),
        "stream_dedup_late": a(_CHUNKS.format(rows="finals", ts="open_time_ts", late=11) + """
, marks AS (SELECT c AS chunk, (SELECT max(open_time_ts) - INTERVAL 10 MINUTE FROM fed f WHERE f.chunk < c) AS mark FROM range(3) AS r(c))
, judged AS (SELECT fed.*, coalesce(date_trunc('millisecond', open_time_ts) <= date_trunc('millisecond', mark), FALSE) AS is_late FROM fed JOIN marks USING (chunk))
, per_key AS (SELECT symbol, open_time_ts, bool_and(is_late) AS late FROM judged GROUP BY 1, 2)
SELECT k.symbol, k.open_time_ts, k.late, CASE WHEN k.late THEN f.close END AS close, CASE WHEN k.late THEN f.ingestion_timestamp END AS ingestion_timestamp
FROM per_key k JOIN finals f ON f.symbol = k.symbol AND f.open_time_ts = k.open_time_ts AND f.rn = 1"""),
        "dead_letters": a(f"""SELECT symbol, open_time, close_time, source_system, ingestion_timestamp, ingestion_timestamp + INTERVAL 1 MINUTE AS quarantine_ts, failed_rule,
  {_PAYLOAD} AS raw_payload, CASE WHEN rescued THEN {_PAYLOAD} END AS rescued_payload FROM quarantine"""),
    }
    grains = [(g, O.rollup_sql("fact", "symbol_id", e, "bucket_start")) for g, e in (
        ("hour", "date_trunc('hour', timestamp_key)"), ("day", "CAST(CAST(timestamp_key AS DATE) AS TIMESTAMP)"))]
    q["rollup_incremental"] = "\nUNION ALL\n".join(f"SELECT '{g}' AS grain, * FROM ({a(sql)})" for g, sql in grains)
    return q
