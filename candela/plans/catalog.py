"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame over the driver tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candela import schemas as S
from candela.operators import gaps as G
from candela.operators import manifest as M
from candela.operators import rollup as R
from candela.operators import serve as V
from candela.operators.dedup import first_arrival
from candela.operators.dims import dim_symbol, dim_time_covering, register_symbols
from candela.operators.fact import fact_klines
from candela.operators.monitors import evaluate_all
from candela.operators.rules import KLINE_RULES, failure_summary
from candela.operators.stage import stage
from candela.operators.universe import flag_candidates, tradable
from candela.operators.upsert import latest_per_key
from candela.plans import adapter as A
from candela.plans.compare import comparable
from candela.plans.layers import stored
from candela.session import scratch_path
from candela.streaming import runner as ST

NOT_COMPARED = ("raw_payload", "_rescued_data", "route", "version", "m")


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return A.table(spark, d, name)


# -- shared frames ---------------------------------------------------------------------------------

def bars_frame(spark, d) -> DataFrame:
    """1-minute bars from the tick table (stored: both input routes read them)."""
    return stored(spark, "bars", d, lambda: A.bars(_t(spark, d, "events")))


def bronze_table(spark, d) -> DataFrame:
    """The bronze table: both routes unified (stored by ``ingest_date``; arrival time and symbol in the range keys, so
    that a day is several tasks)."""
    def build():
        return (A.bronze_from_events(_t(spark, d, "events"), bars_frame(spark, d))
                 .withColumn("ingest_date", F.to_date("ingestion_timestamp")))
    return stored(spark, "bronze", d, build, partition_by=["ingest_date"], sort_by=["ingestion_timestamp", "symbol"])


def bronze_frame(spark, d) -> DataFrame:
    return bronze_table(spark, d).drop("ingest_date")


def staged_frame(spark, d) -> DataFrame:
    """The silver staged table (built once per input folder, then read back)."""
    def build():
        return stage(bronze_frame(spark, d)).withColumn("candle_date", F.to_date("open_time_ts"))
    return stored(spark, "silver_staged", d, build, partition_by=["candle_date"],
                  sort_by=["symbol", "open_time_ts", "ingestion_timestamp"]).drop("candle_date")  # arrival spreads rows without open time


def quarantine_table(spark, d) -> DataFrame:
    """The dead letters (stored by ``ingest_date``: alerts look at recent arrivals)."""
    def build():
        return KLINE_RULES.quarantine(staged_frame(spark, d)).withColumn("ingest_date", F.to_date("ingestion_timestamp"))
    return stored(spark, "quarantine", d, build, partition_by=["ingest_date"], sort_by=["ingestion_timestamp", "symbol"])


def valid_frame(spark, d) -> DataFrame:
    return KLINE_RULES.valid(staged_frame(spark, d))


def dim_frame(spark, d) -> DataFrame:
    """The gold symbol dimension (stored)."""
    return stored(spark, "gold_dim_symbol", d,
                  lambda: dim_symbol(A.symbol_records_from_tables(_t(spark, d, "events"), _t(spark, d, "orders"))))


def fact_frame(spark, d) -> DataFrame:
    """The gold fact (stored, partitioned by ``fact_date`` and sorted by symbol and minute)."""
    def build():
        return fact_klines(valid_frame(spark, d), dim_frame(spark, d)).withColumn("fact_date", F.to_date("timestamp_key"))
    return stored(spark, "gold_fact", d, build, partition_by=["fact_date"], sort_by=["symbol_id", "timestamp_key"])


def as_of(spark, d):
    return G.as_of_from(_t(spark, d, "events"), "ts")


# -- queries ---------------------------------------------------------------------------------------

def q_bars_1m(spark, d):
    return comparable(A.bars(_t(spark, d, "events")))


def q_bronze_union(spark, d):
    b = bronze_frame(spark, d)
    return comparable(b.withColumn("rescued", F.col(S.RESCUE_COLUMN).isNotNull()), drop=NOT_COMPARED)


def q_staged(spark, d):
    return comparable(staged_frame(spark, d), drop=NOT_COMPARED)


def q_rules_valid(spark, d):
    return comparable(valid_frame(spark, d), drop=NOT_COMPARED)


def q_rules_quarantine(spark, d):
    return comparable(KLINE_RULES.quarantine(staged_frame(spark, d)), drop=NOT_COMPARED + ("quarantine_ts",))


def q_rules_summary(spark, d):
    return failure_summary(KLINE_RULES.quarantine(staged_frame(spark, d)))


def q_upsert_scd1(spark, d):
    return comparable(latest_per_key(valid_frame(spark, d)), drop=NOT_COMPARED)


def q_dedup_first(spark, d):
    return comparable(first_arrival(valid_frame(spark, d).filter(F.col("is_final"))), drop=NOT_COMPARED)


def q_universe_filter(spark, d):
    listing = stored(spark, "listing", d, lambda: A.exchange_listing(_t(spark, d, "events"), _t(spark, d, "orders")))
    # candidates: what is listed, and names that no exchange lists
    names = listing.select("symbol").union(_t(spark, d, "nation").select("n_name"))
    checked = flag_candidates(names, tradable(listing))
    about = listing.select("symbol", "status", F.col("quoteAsset").alias("quote_asset"))
    return checked.join(about, "symbol", "left").select("symbol", "status", "quote_asset", F.when(F.col("in_universe"), "kept").otherwise("dropped").alias("decision"))


def q_dim_symbol(spark, d):
    return dim_frame(spark, d)


def q_dim_time_month(spark, d):
    return comparable(dim_time_covering(A.ticks(_t(spark, d, "events")), "ts"))


def q_fact_bars(spark, d):
    return comparable(fact_frame(spark, d).drop("fact_date"))


def q_rollup_hourly(spark, d):
    return comparable(R.hourly_summary(fact_frame(spark, d)))


def q_rollup_daily(spark, d):
    return comparable(R.daily_summary(fact_frame(spark, d)))


def q_rollup_lineitem_daily(spark, d):
    li = _t(spark, d, "lineitem")
    qty = F.col("l_quantity").cast(S.PRICE)
    src = li.select("l_partkey", F.col("l_shipdate").cast("timestamp").alias("l_shipdate"),
                    qty.alias("volume"), F.col("l_extendedprice").cast(S.PRICE).alias("quote"),
                    F.when(F.col("l_returnflag") == "R", qty).otherwise(F.lit(0)).alias("taker"))
    return comparable(R.rollup(src, "day", key="l_partkey", ts="l_shipdate", ohlc=False, volume="volume",
                               quote="quote", trades=None, taker="taker"))


def q_gap_report(spark, d):
    return comparable(G.gap_report(fact_frame(spark, d), dim_frame(spark, d), as_of(spark, d)))


def q_gap_report_today(spark, d):
    return comparable(G.gap_report(fact_frame(spark, d), dim_frame(spark, d), as_of(spark, d), include_today=True))


def q_gap_report_sparse(spark, d):
    return comparable(G.gap_report_sparse(fact_frame(spark, d), dim_frame(spark, d), as_of(spark, d)))


def q_gap_runs(spark, d):
    return comparable(G.gap_runs(fact_frame(spark, d), dim_frame(spark, d), as_of(spark, d)))


def q_monitors(spark, d):
    now = as_of(spark, d)
    # up to the last minute: whole days before today would never reach into the look-back
    gaps = G.gap_report_sparse(fact_frame(spark, d), dim_frame(spark, d), now, lookback_days=1, include_today=True)
    return evaluate_all(bronze_table(spark, d), quarantine_table(spark, d), gaps, now)


def _orders_calendar(spark, d):
    o = _t(spark, d, "orders")
    listings = o.groupBy(F.col("o_orderpriority").alias("symbol")).agg(F.min("o_orderdate").alias("first_ts"))
    months = o.select(F.col("o_orderpriority").alias("symbol"), F.year("o_orderdate").alias("year"),
                      F.month("o_orderdate").alias("month")).distinct()
    landed = months.filter((F.col("year") * 12 + F.col("month")) % 7 != 0)
    now = o.agg(F.max("o_orderdate").alias("t")).first()["t"]
    return listings, months, landed, now


def q_backfill_manifest(spark, d):
    listings, _, landed, now = _orders_calendar(spark, d)
    return M.to_fetch(M.month_series(listings, now), landed)


def _daily(spark, d):
    return R.daily_summary(fact_frame(spark, d))


def q_daily_price_action(spark, d):
    return comparable(V.daily_price_action(_daily(spark, d)))


def q_market_sentiment(spark, d):
    return comparable(V.market_sentiment(fact_frame(spark, d)))


def q_volatility_rank(spark, d):
    return comparable(V.volatility_rank(_daily(spark, d)))


def q_volume_analysis(spark, d):
    return comparable(V.volume_analysis(fact_frame(spark, d)))


def q_session_breakdown(spark, d):
    return comparable(V.session_breakdown(fact_frame(spark, d)))


# -- streaming ------------------------------------------------------------------------------------

def _feed_in_chunks(spark, rows: DataFrame, date_col, input_dir: str, run_once, n: int = 3) -> None:
    """Append ``rows`` to a stream's input folder in ``n`` consecutive date ranges and run the
    stream incrementally after each (one scheduled refresh per range)."""
    day = F.datediff(date_col, F.lit("1970-01-01"))
    b = rows.agg(F.min(day).alias("lo"), F.max(day).alias("hi")).first()
    span = b.hi - b.lo + 1
    chunk = F.coalesce(F.floor((day - F.lit(b.lo)) * n / F.lit(span)), F.lit(0))  # rows without a date come first
    for k in range(n):
        rows.filter(chunk == k).write.mode("append").parquet(input_dir)
        run_once()


def q_stream_scd1(spark, d):
    base = scratch_path(spark, "stream-scd1")
    bronze = bronze_frame(spark, d)
    inp, clean, quar = f"{base}/input", f"{base}/clean", f"{base}/quarantine"

    def run_once():
        src = stage(spark.readStream.schema(bronze.schema).parquet(inp))
        ST.run(src, f"{base}/_ckpt", foreach_batch=ST.silver_batch_writer(clean, quar))
    _feed_in_chunks(spark, bronze, F.to_date("ingestion_timestamp"), inp, run_once)
    return comparable(spark.read.parquet(clean).drop(ST.DATE_COL), drop=NOT_COMPARED)


def q_stream_fact(spark, d):
    base = scratch_path(spark, "stream-fact")
    bronze, dim = bronze_frame(spark, d), dim_frame(spark, d)
    inp, fact = f"{base}/input", f"{base}/fact"

    def run_once():
        src = KLINE_RULES.valid(stage(spark.readStream.schema(bronze.schema).parquet(inp)))
        ST.run(src, f"{base}/_ckpt", foreach_batch=ST.fact_batch_writer(fact, dim))
    _feed_in_chunks(spark, bronze, F.to_date("ingestion_timestamp"), inp, run_once)
    return comparable(spark.read.parquet(fact).drop(ST.DATE_COL))


def q_stream_fact_new_symbol(spark, d):
    """A symbol joins between two refreshes: ids come from the registry, so the rows stored before keep theirs."""
    base = scratch_path(spark, "stream-fact-new-symbol")
    rows, records = staged_frame(spark, d), dim_frame(spark, d).drop("symbol_id")
    first = records.agg(F.min("symbol").alias("s")).first()["s"]
    new = F.col("symbol").eqNullSafe(F.lit(first))
    inp, fact, registry = f"{base}/input", f"{base}/fact", f"{base}/symbols"
    for some, known in ((~new, records.filter(~new)), (new, records)):
        dim = register_symbols(registry, known)
        rows.filter(some).write.mode("append").parquet(inp)
        src = KLINE_RULES.valid(spark.readStream.schema(rows.schema).parquet(inp))
        ST.run(src, f"{base}/_ckpt", foreach_batch=ST.fact_batch_writer(fact, dim))
    return comparable(spark.read.parquet(fact).drop(ST.DATE_COL).join(dim.select("symbol", "symbol_id"), "symbol_id").drop("symbol_id"))


def q_stream_quarantine(spark, d):
    base = scratch_path(spark, "stream-quarantine")
    bronze = bronze_frame(spark, d)
    inp, quar = f"{base}/input", f"{base}/quarantine"

    def run_once():
        src = stage(spark.readStream.schema(bronze.schema).option("maxFilesPerTrigger", "64").parquet(inp))
        ST.run(src, f"{base}/_ckpt", foreach_batch=ST.silver_batch_writer(f"{base}/clean", quar))
    _feed_in_chunks(spark, bronze, F.to_date("ingestion_timestamp"), inp, run_once)
    return comparable(spark.read.parquet(quar), drop=NOT_COMPARED + ("quarantine_ts", "run", "batch_id"))


def q_stream_daily_final(spark, d):
    base = scratch_path(spark, "stream-daily")
    fact = fact_frame(spark, d).drop("fact_date")
    inp, out = f"{base}/input", f"{base}/daily"

    def run_once():
        src = ST.bucket_final(spark.readStream.schema(fact.schema).parquet(inp), "day")
        ST.run(src, f"{base}/_ckpt", sink_path=out)
    _feed_in_chunks(spark, fact, F.to_date("timestamp_key"), inp, run_once)
    return comparable(spark.read.parquet(out))


def q_stream_hourly_final(spark, d):
    base = scratch_path(spark, "stream-hourly")
    fact = fact_frame(spark, d).drop("fact_date")
    inp, out = f"{base}/input", f"{base}/hourly"

    def run_once():
        src = ST.hourly_final(spark.readStream.schema(fact.schema).parquet(inp))
        ST.run(src, f"{base}/_ckpt", sink_path=out)
    _feed_in_chunks(spark, fact, F.to_date("timestamp_key"), inp, run_once)
    return comparable(spark.read.parquet(out))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    from candela.plans.landing import QUERIES
    return QUERIES | {
        "bars_1m": q_bars_1m,
        "bronze_union": q_bronze_union,
        "staged": q_staged,
        "rules_valid": q_rules_valid,
        "rules_quarantine": q_rules_quarantine,
        "rules_summary": q_rules_summary,
        "upsert_scd1": q_upsert_scd1,
        "dedup_first": q_dedup_first,
        "universe_filter": q_universe_filter,
        "dim_symbol": q_dim_symbol,
        "dim_time_month": q_dim_time_month,
        "fact_bars": q_fact_bars,
        "rollup_hourly": q_rollup_hourly,
        "rollup_daily": q_rollup_daily,
        "rollup_lineitem_daily": q_rollup_lineitem_daily,
        "gap_report": q_gap_report,
        "gap_report_today": q_gap_report_today,
        "gap_report_sparse": q_gap_report_sparse,
        "gap_runs": q_gap_runs,
        "monitors": q_monitors,
        "backfill_manifest": q_backfill_manifest,
        "daily_price_action": q_daily_price_action,
        "market_sentiment": q_market_sentiment,
        "volatility_rank": q_volatility_rank,
        "volume_analysis": q_volume_analysis,
        "session_breakdown": q_session_breakdown,
        "stream_scd1": q_stream_scd1,
        "stream_fact": q_stream_fact,
        "stream_hourly_final": q_stream_hourly_final,
        "stream_daily_final": q_stream_daily_final,
        "stream_quarantine": q_stream_quarantine,
        "stream_fact_new_symbol": q_stream_fact_new_symbol,
    }
