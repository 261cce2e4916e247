"""Queries that go through files and streams as the pipeline does: rows derived from the driver tables are landed (CSV folders, message
text, zip archives, the metadata document) and found again by the sources."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candela import schemas as S
from candela.operators import gaps as G
from candela.operators import manifest as M
from candela.operators import rollup as R
from candela.operators import serve as V
from candela.operators.dedup import first_arrival
from candela.operators.expectations import ExpectationError, publish
from candela.operators.monitors import MISSING_MINUTES, QUARANTINE, SCHEMA_DRIFT, history
from candela.operators.rules import KLINE_RULES
from candela.plans import adapter as A
from candela.plans import catalog as C
from candela.plans.compare import comparable
from candela.session import scratch_path
from candela.sources import archives as Z
from candela.sources.metadata import read_symbol_metadata, write_symbol_metadata
from candela.streaming import live as L
from candela.streaming import runner as ST

#: Feeds arrive in this many consecutive day ranges, one scheduled refresh each.
REFRESHES = 3


def _raw(spark, d) -> DataFrame:
    """Every version of every bar as source text, with the refresh that it arrives before."""
    r = A.raw(A.versions(C.bars_frame(spark, d)))
    return r.withColumns({"year": F.year("open_time_ts"), "month": F.month("open_time_ts"), "chunk": _chunk(r, "open_time_ts")})


def _chunk(rows: DataFrame, ts: str) -> Column:
    day = F.datediff(F.to_date(ts), F.lit("1970-01-01"))
    b = rows.agg(F.min(day).alias("lo"), F.max(day).alias("hi")).first()
    if b["lo"] is None:
        return F.lit(0)
    return F.floor((day - F.lit(b["lo"])) * REFRESHES / F.lit(b["hi"] - b["lo"] + 1)).cast("int")


def _landed(rows: DataFrame) -> DataFrame:
    """Comparable columns of bronze rows from files: the landing month instead of the file's name."""
    return comparable(rows.withColumns({"landed": Z.landed_month(F.col("source_file")), "rescued": F.col(S.RESCUE_COLUMN).isNotNull()}),
                      drop=(*C.NOT_COMPARED, "source_file", "ingestion_timestamp"))


def q_csv_archives(spark, d):
    """Archive rows landed as CSV in month folders, in two landings, each found by a file stream; every third minute's symbol has a space."""
    base = scratch_path(spark, "csv-archives")
    root, out = f"{base}/raw_klines", f"{base}/bronze"
    spaced = F.when(F.col("m") % 3 == 0, F.concat("symbol", F.lit(" perp"))).otherwise(F.col("symbol"))
    rows = _raw(spark, d).filter("route = 'archive'").withColumn("symbol", spaced)
    for late in (False, True):
        Z.write_landing(rows.filter((F.col("chunk") == REFRESHES - 1) == late), root)
        ST.run(Z.read_csv_archives(spark, root, streaming=True, max_files_per_trigger=64), f"{base}/_ckpt", sink_path=out)
    return _landed(spark.read.parquet(out))


def q_stream_bronze_union(spark, d):
    """Both routes as one stream into one bronze table: CSV lines and message text, three refreshes, the message route idle in the second."""
    base = scratch_path(spark, "stream-bronze-union")
    csv, text = f"{base}/raw_klines", f"{base}/messages"
    paths, rows = L.Paths(base), _raw(spark, d)
    line = A.csv_lines(rows, "symbol", "year", "month", "chunk")
    message = A.messages(rows, "chunk")
    messages_of = {0: [0], 2: [1, 2]}   # by refresh; in the second no message has come
    for k in range(REFRESHES):
        Z.write_landing_lines(line.filter(F.col("chunk") == k), csv)
        if k in messages_of:
            message.filter(F.col("chunk").isin(messages_of[k])).select("value").write.mode("append").text(text)
        source = spark.readStream.option("maxFilesPerTrigger", "64").text(text)
        L.run_bronze(spark, csv, paths, messages=source, max_files_per_trigger=64)
    return _landed(spark.read.parquet(paths.bronze))


def q_stream_dedup_late(spark, d):
    """Valid final candles through the watermark dedup in three refreshes; candles of every eleventh minute are held back by one refresh. The
    rows the dedup dropped as late are merged by the batch route: every candle once, with the measures of those that came late."""
    base = scratch_path(spark, "stream-dedup-late")
    rows = KLINE_RULES.valid(C.staged_frame(spark, d)).filter("is_final")
    held = F.pmod(F.unix_seconds("open_time_ts") / 60, F.lit(11)).cast("int") == 0
    rows = rows.withColumn("chunk", F.least(_chunk(rows, "open_time_ts") + held.cast("int"), F.lit(REFRESHES - 1)))
    paths, schema = L.Paths(base), rows.drop("chunk").schema
    for k in range(REFRESHES):
        rows.filter(F.col("chunk") == k).drop("chunk").write.mode("append").parquet(paths.input)
        L.run_dedup(spark, lambda: spark.readStream.schema(schema).parquet(paths.input), paths)
    late = first_arrival(spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(paths.late))
    kept = spark.read.parquet(paths.deduped)
    key = ["symbol", "open_time_ts"]
    came = lambda c: F.lit(None).cast(schema[c].dataType).alias(c)  # noqa: E731 - which copy of a live candle stays is not fixed
    out = kept.select(*key, F.lit(False).alias("late"), came("close"), came("ingestion_timestamp")).unionByName(
        late.select(*key, F.lit(True).alias("late"), "close", "ingestion_timestamp"))
    return comparable(out)


def q_zip_archives(spark, d):
    """Every version of every bar packed into monthly zip archives, landed as files beside a cut-off one, and read back."""
    root = f"{scratch_path(spark, 'zip-archives')}/raw_klines"
    lines = A.csv_lines(_raw(spark, d).withColumn("route", F.lit("archive")), "symbol", "year", "month")
    zips = _zipped(lines.withColumn("at", F.split("line", ",").getItem(0).try_cast("long")))
    broken = zips.orderBy("symbol", "year", "month").limit(1).select(
        "symbol", (F.col("year") - 1).alias("year"), "month", F.expr("substring(content, 1, length(content) div 2)").alias("content"))
    Z.write_archives(zips, root)
    Z.write_archives(broken, root)
    return _landed(Z.archive_rows(Z.read_zip_archives(spark, root, "*")))


def _zipped(lines: DataFrame) -> DataFrame:
    """One archive for each (symbol, year, month) of lines ordered by ``at``."""
    named = lines.select(F.format_string("symbol=%s/year=%d/month=%02d.zip", F.coalesce("symbol", F.lit(Z.NO_VALUE)), "year", "month").alias("path"), "line", F.col("at").alias("open_time"))
    part = lambda p: F.regexp_extract("path", p, 1)
    return Z.zip_monthly(named).select(F.nullif(part("symbol=([^/]+)"), F.lit(Z.NO_VALUE)).alias("symbol"), part(r"year=(\d+)").cast("int").alias("year"),
                                       part(r"month=(\d+)").cast("int").alias("month"), "content")


def _order_lines(orders: DataFrame) -> DataFrame:
    """A candle line for every order priority and day: prices are the totals of its orders."""
    p = F.col("o_totalprice").cast(S.PRICE)
    daily = orders.groupBy(F.col("o_orderpriority").alias("symbol"), F.to_date("o_orderdate").alias("day")).agg(
        F.min(p).alias("low"), F.max(p).alias("high"), F.count(F.lit(1)).alias("n"), F.sum(p).alias("quote"))
    at = F.unix_millis(F.col("day").cast("timestamp"))
    fields = [at, F.col("low"), F.col("high"), F.col("low"), F.col("high"), F.col("n"), at + 86_399_999, F.col("quote"), F.col("n"), F.lit(0), F.lit(0), F.lit(0)]
    return daily.select("symbol", F.year("day").alias("year"), F.month("day").alias("month"), F.concat_ws(",", *(f.cast("string") for f in fields)).alias("line"), at.alias("at"))


def q_ingest_status(spark, d):
    """Outcomes of a backfill over the order calendar: months not landed are fetched as zip archives from storage, where every fifth is missing and
    every third of the others is cut off."""
    listings, _, landed, now = C._orders_calendar(spark, d)
    number = F.col("year") * 12 + F.col("month")
    offered = _order_lines(C._t(spark, d, "orders")).filter((number % 7 == 0) & (number % 5 != 0))
    cut = F.when(number % 3 == 0, F.expr("substring(content, 1, length(content) div 2)")).otherwise(F.col("content"))
    root = f"{scratch_path(spark, 'ingest-status')}/raw_klines"
    Z.write_archives(_zipped(offered).withColumn("content", cut), root)
    outcomes = Z.archive_outcomes(Z.read_zip_archives(spark, root, "*"))
    return M.status_summary(M.month_status(M.month_series(listings, now), landed, outcomes))


def q_metadata_document(spark, d):
    """The symbol records as one metadata document, written and read back, with each record's place in it."""
    path = f"{scratch_path(spark, 'metadata')}/symbols"
    write_symbol_metadata(A.symbol_records_from_tables(C._t(spark, d, "events"), C._t(spark, d, "orders")), path)
    return read_symbol_metadata(spark, path, position="position")


def q_star_join(spark, d):
    fact = C.fact_frame(spark, d)
    joined = V.join_dim_time(fact, V.dim_time_of(fact))
    return comparable(joined.select("symbol_id", "timestamp_key", "close", "volume", F.col("fact_date").alias("date"), "year", "quarter", "month", "day",
                                    "hour", "minute", "day_name", "day_of_week", "is_weekend", "trading_session"))


def _arrivals(spark, d) -> DataFrame:
    """Staged candles by when they reach the table: messages at once, an archive day in its landing five minutes after the day's end."""
    at = F.col("ingestion_timestamp")
    landing = F.date_trunc("day", at) + F.expr("INTERVAL 1 DAY 5 MINUTES")
    return C.staged_frame(spark, d).withColumn("ingestion_timestamp", F.when(F.col("source_system") == S.SOURCE_ARCHIVE, landing).otherwise(at))


def q_monitor_history(spark, d):
    """The three monitors at every fifth minute from an hour before the first day to the last tick."""
    now, rows, fact = C.as_of(spark, d), _arrivals(spark, d), C.fact_frame(spark, d)
    first = fact.agg(F.min("fact_date").alias("day")).first()["day"] or now.date()
    begin = dt.datetime(first.year, first.month, first.day)
    gaps = G.gap_report_sparse(fact, C.dim_frame(spark, d), now, lookback_days=(now - begin).days + 1, include_today=True)
    gaps = gaps.filter(F.col("missing_minute") >= F.lit(begin.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp"))
    return comparable(history([(SCHEMA_DRIFT, rows), (QUARANTINE, KLINE_RULES.quarantine(rows)), (MISSING_MINUTES, gaps)], begin - dt.timedelta(hours=1), now))


def q_expectation_counts(spark, d):
    """The fact's expectations observed while it is written: once over all final candles, faults included (not published), once over the valid."""
    base, dim = scratch_path(spark, "expectations"), C.dim_frame(spark, d).select("symbol", "symbol_id")
    rows = []
    for table, candles in (("all", C.staged_frame(spark, d)), ("valid", C.valid_frame(spark, d))):
        keyed = candles.filter("is_final").join(dim, "symbol", "left").select("symbol_id", F.col("open_time_ts").alias("timestamp_key"), "close", "ingestion_timestamp")
        try:
            counts, done = publish(keyed, f"{base}/{table}", S.FACT_EXPECTATIONS), True
        except ExpectationError as e:
            counts, done = e.counts, False
        rows += [(table, n, counts["n_rows"], counts[n], done) for n, _ in S.FACT_EXPECTATIONS]
    return spark.createDataFrame(rows, "candles string, expectation string, n_rows bigint, n_violations bigint, published boolean")


def q_rollup_incremental(spark, d):
    """Hourly and daily summaries kept as partial sums by the fact's refreshes; every fourth minute arrives a refresh late, into days
    that are summed already."""
    base, dim = scratch_path(spark, "rollup-incremental"), C.dim_frame(spark, d)
    rows = C.valid_frame(spark, d)
    late = F.pmod(F.unix_seconds("open_time_ts") / 60, F.lit(4)).cast("int") == 0
    chunk = F.least(_chunk(rows, "open_time_ts") + late.cast("int"), F.lit(REFRESHES - 1))
    inp, summed = f"{base}/input", f"{base}/partials"
    for k in range(REFRESHES):
        rows.filter(chunk == k).write.mode("append").parquet(inp)
        ST.run(spark.readStream.schema(rows.schema).parquet(inp), f"{base}/_ckpt", foreach_batch=ST.fact_batch_writer(f"{base}/fact", dim, partial_base=summed))
    out = None
    for grain, table in (("hour", "hours"), ("day", "days")):
        s = R.summary(spark.read.parquet(f"{summed}/{table}"), grain)
        s = s.select(F.lit(grain).alias("grain"), F.col(R.bucket_name(grain)).cast("timestamp").alias("bucket_start"), *(c for c in s.columns if c != R.bucket_name(grain)))
        out = s if out is None else out.unionByName(s)
    return comparable(out)


def q_dead_letters(spark, d):
    """Dead letters with their payload, stamped a minute after arrival."""
    stamp = F.col("ingestion_timestamp") + F.expr("INTERVAL 1 MINUTE")
    q = KLINE_RULES.quarantine(C.staged_frame(spark, d), stamp)
    return comparable(q.select("symbol", "open_time", "close_time", "source_system", "ingestion_timestamp", "quarantine_ts", "failed_rule", "raw_payload",
                               F.when(F.col("source_system") == S.SOURCE_STREAM, F.col(S.RESCUE_COLUMN)).alias("rescued_payload")))


QUERIES = {f.__name__[2:]: f for f in (
    q_csv_archives, q_stream_bronze_union, q_stream_dedup_late, q_zip_archives, q_ingest_status, q_metadata_document, q_star_join, q_monitor_history,
    q_expectation_counts, q_rollup_incremental, q_dead_letters)}
