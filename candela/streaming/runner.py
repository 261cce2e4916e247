"""Streaming runners.

Sources are file streams (archive CSVs, parquet hand-over tables) or any streaming frame with a
``value`` column (a message broker). Each runner is one ``writeStream`` with its own checkpoint
under the shared checkpoint folder, so a restarted or re-scheduled run resumes where it stopped;
``trigger(availableNow=True)`` gives the scheduled incremental refresh, ``processingTime`` the
continuous one.

Keyed tables (silver clean, fact) are maintained in ``foreachBatch`` by merging the micro-batch
into the date partitions it touches (parquet; finished partitions written beside the table take the old ones' place). The merge keeps the
greatest sequence (upsert) or the earliest arrival (fact), so replaying a batch after a failure
changes nothing and the outcome does not depend on arrival order: history loaded after live data
is not dropped as late, which a watermark-bounded dedup would do.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candela import schemas as S
from candela.operators.dedup import first_arrival
from candela.operators.fact import to_fact
from candela.operators.rollup import bucket_name, merge_partials, partials, ratios, rollup, sums
from candela.operators.rules import KLINE_RULES, RuleSet
from candela.operators.upsert import KLINE_KEYS, KLINE_SEQUENCE, latest_per_key
from candela.session import folders, move, remove, table_exists, write_finished

DATE_COL = "candle_date"


def merge_into_dates(batch: DataFrame, target: str, date_expr, keys: list[str], combine: Callable[[DataFrame], DataFrame]) -> list:
    """Merge rows into a parquet table partitioned by date: read only the touched partitions,
    combine with the batch, overwrite just those partitions. The list of touched dates is the
    only thing brought to the driver (bounded by the days in one batch); it is returned.

    The merged partitions are written once, whole, under ``target/_merge``, which readers skip; each then takes its old one's
    place by a change of name (on object stores a copy by the store itself). A run that finds a finished ``_merge`` carries the
    rest of the moves through before anything else, and one that finds it unfinished drops it. One writer per table.
    Rows are ranged on (date, keys): a micro-batch of one day is several tasks."""
    spark = batch.sparkSession
    pending = f"{target.rstrip('/')}/_merge/rows"
    _carry_through(spark, pending, target)
    b = batch.withColumn(DATE_COL, date_expr)
    dates = [r[0] for r in b.select(DATE_COL).distinct().collect()]
    if not dates:
        return dates
    if table_exists(spark, target):
        current = spark.read.parquet(target)
        mine = F.col(DATE_COL).isin([x for x in dates if x is not None])
        current = current.filter(mine | F.col(DATE_COL).isNull() if None in dates else mine)
        merged = combine(current.unionByName(b.select(*current.columns)))
    else:
        merged = combine(b)
    order = [F.col(c) for c in (DATE_COL, *keys)]
    merged.repartitionByRange(*order).sortWithinPartitions(*order).write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(DATE_COL).parquet(pending)
    _carry_through(spark, pending, target)
    return dates


def _carry_through(spark: SparkSession, pending: str, target: str) -> None:
    if write_finished(spark, pending):
        for name in folders(spark, pending):    # a date that has moved is no longer here
            move(spark, f"{pending}/{name}", f"{target.rstrip('/')}/{name}")
        spark.catalog.refreshByPath(target)
    remove(spark, pending)


def silver_batch_writer(clean_path: str, quarantine_path: str, rules: RuleSet = KLINE_RULES,
                        keys: list[str] = KLINE_KEYS, sequence: list[str] = KLINE_SEQUENCE):
    """foreachBatch body: one read of the staged micro-batch, both routes written.

    clean: upsert (greatest sequence per key) into date partitions;
    quarantine: rows failing any rule, in a ``batch_id=`` partition overwritten on replay.
    """
    own_run = uuid.uuid4().hex  # for batches handed over outside of a streaming query

    def write(batch: DataFrame, batch_id: int) -> None:
        tagged = rules.tag(batch).persist()
        try:
            clean = tagged.filter("is_valid").drop("is_valid", "failed_rule", "failed_rules")
            merge_into_dates(clean, clean_path, F.to_date("open_time_ts"), keys,
                             lambda df: latest_per_key(df, keys + [DATE_COL], sequence))
            q = (tagged.filter(~F.col("is_valid")).drop("is_valid")
                       .withColumn("quarantine_ts", F.current_timestamp()))
            # batch numbers restart with every checkpoint: the query's id (kept in its checkpoint, so
            # a replayed batch overwrites itself) tells two runs apart
            run = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or own_run
            q.write.mode("overwrite").parquet(f"{quarantine_path.rstrip('/')}/run={run}/batch_id={batch_id}")
        finally:
            tagged.unpersist()
    return write


def fact_batch_writer(fact_path: str, dim_symbol: DataFrame, hourly_path: str | None = None, partial_base: str | None = None):
    """foreachBatch body: final candles of the batch -> fact rows, merged so the earliest arrival
    per (symbol, minute) wins across all batches (deterministic, replay-safe). Stored ids must not change
    between batches: take the dimension from ``dims.register_symbols`` where symbols are added.
    With ``hourly_path`` the hourly summary of the touched dates is made anew; with ``partial_base`` the mergeable hours and days of
    these dates are (:func:`refresh_partials`)."""
    def write(batch: DataFrame, batch_id: int) -> None:
        finals = batch.filter(F.col("is_final"))
        fact = to_fact(first_arrival(finals), dim_symbol).persist()  # read for the dates and for the merge
        try:
            dates = merge_into_dates(fact, fact_path, F.to_date("timestamp_key"), ["symbol_id", "timestamp_key"],
                             lambda df: first_arrival(df, ["symbol_id", "timestamp_key"],
                                                      ["ingestion_timestamp", "source_system"]))
            if hourly_path and dates:
                rebuild_dates(batch.sparkSession, fact_path, hourly_path, dates)
            if partial_base and dates:
                refresh_partials(batch.sparkSession, fact_path, partial_base, dates)
        finally:
            fact.unpersist()
    return write


def bucket_final(fact_stream: DataFrame, grain: str = "hour", delay: str | None = S.HOURLY_FINAL_DELAY, key: str = "symbol_id",
                 ts: str = "timestamp_key") -> DataFrame:
    """Finalised summary per ``hour`` or ``day`` for append mode: a bucket is emitted once, when the watermark
    (max event time - delay) passes its end; late in-bucket rows that arrive before then are
    included. Grouping uses ``window()`` (a plain truncation is not allowed in append mode).
    ``delay=None`` keeps a watermark defined upstream (a stream may define only one).
    Rows later than the watermark are not in it: :func:`rebuild_dates` makes such buckets anew from the stored fact."""
    src = fact_stream.withWatermark(ts, delay) if delay else fact_stream
    g = src.groupBy(key, F.window(ts, f"1 {grain}").alias("w")).agg(*sums(ts))
    start = F.col("w.start").cast("date") if grain == "day" else F.col("w.start")
    return g.select(key, start.alias(bucket_name(grain)), *ratios())


def hourly_final(fact_stream: DataFrame, delay: str | None = S.HOURLY_FINAL_DELAY, key: str = "symbol_id",
                 ts: str = "timestamp_key") -> DataFrame:
    return bucket_final(fact_stream, "hour", delay, key, ts)


def rebuild_dates(spark: SparkSession, fact_path: str, summary_path: str, dates: list, grain: str = "hour") -> None:
    """Summaries of the dates whose fact rows have changed, made anew from the stored fact: the summary table, partitioned by
    date, then holds late rows too. Work follows the touched dates, not the history."""
    fact = spark.read.parquet(fact_path).filter(F.col(DATE_COL).isin(dates))
    day = F.to_date(bucket_name(grain))
    (rollup(fact, grain).withColumn(DATE_COL, day).repartitionByRange(DATE_COL, "symbol_id").write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic").partitionBy(DATE_COL).parquet(summary_path))


def _overwrite_dates(rows: DataFrame, path: str) -> None:
    (rows.repartitionByRange(DATE_COL, "symbol_id").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(DATE_COL).parquet(path))


def refresh_partials(spark: SparkSession, fact_path: str, base: str, dates: list) -> None:
    """The ``hours`` and ``days`` tables under ``base`` after a change of the fact's ``dates``: hours from the fact's rows of these dates,
    then days from these hours (at most 24 rows a symbol and day, whatever the fact holds). Replaying changes nothing."""
    hours, days = f"{base.rstrip('/')}/hours", f"{base.rstrip('/')}/days"
    touched = F.col(DATE_COL).isin(dates)
    fresh = partials(spark.read.parquet(fact_path).filter(touched), "hour")
    _overwrite_dates(fresh.withColumn(DATE_COL, F.to_date(bucket_name("hour"))), hours)
    made = merge_partials(spark.read.parquet(hours).filter(touched), "day")
    _overwrite_dates(made.withColumn(DATE_COL, F.col(bucket_name("day"))), days)


def divert_late(kept_path: str, late_path: str, keys: list[str], event_time: str):
    """foreachBatch body of the second query over a source whose first query dedups under a watermark into ``kept_path``: rows whose
    key the first one has not kept were too late for it. They go to ``late_path``, in a partition that a replay overwrites.

    The first query must have finished the same input (one scheduled refresh runs both, in this order). Only the kept rows of the
    batch's days are read."""
    own_run = uuid.uuid4().hex

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        b = batch.withColumn(DATE_COL, F.to_date(event_time)).persist()
        try:
            days = [r[0] for r in b.select(DATE_COL).distinct().collect()]
            if not days:
                return
            late = b
            if table_exists(spark, kept_path):
                kept = spark.read.parquet(kept_path).filter(F.to_date(event_time).isin(days)).select(*keys)
                late = b.join(kept, keys, "left_anti")
            run_id = spark.sparkContext.getLocalProperty("sql.streaming.queryId") or own_run
            late.drop(DATE_COL).write.mode("overwrite").parquet(f"{late_path.rstrip('/')}/run={run_id}/batch_id={batch_id}")
        finally:
            b.unpersist()
    return write


def run(stream: DataFrame, checkpoint: str, *, foreach_batch=None, sink_path: str | None = None,
        output_mode: str = "append", available_now: bool = True, processing_time: str | None = None,
        query_name: str | None = None):
    """Start one streaming query. With ``available_now`` it processes everything new and stops
    (awaited here); otherwise it runs continuously and the handle is returned."""
    w = stream.writeStream.option("checkpointLocation", checkpoint).outputMode(output_mode)
    if query_name:
        w = w.queryName(query_name)
    if foreach_batch is not None:
        w = w.foreachBatch(foreach_batch)
    else:
        w = w.format("parquet").option("path", sink_path)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time or "1 minute")
    q = w.start()
    if available_now:
        q.awaitTermination()
        exc = q.exception()
        if exc is not None:
            raise exc
    return q
