"""Completeness: missing minutes per symbol over a look-back window, without a cross join."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from candela import schemas as S


def as_of_from(df: DataFrame, ts: str) -> dt.datetime:
    """Latest timestamp of a table as a naive UTC datetime (one global max, a single scalar;
    taken as epoch micros so the driver's local zone plays no part)."""
    us = df.agg(F.max(F.unix_micros(F.col(ts).cast("timestamp"))).alias("t")).first()["t"]
    return dt.datetime(1970, 1, 1) + dt.timedelta(microseconds=us)


def window_bounds(as_of: dt.datetime, lookback_days: int = S.GAP_LOOKBACK_DAYS,
                  include_today: bool = False) -> tuple[dt.datetime, dt.datetime]:
    """[start, end) of the check. Default: the ``lookback_days`` whole days before as_of's day
    (today is never checked). ``include_today``: the last ``lookback_days`` x 24 h up to as_of."""
    if include_today:
        end = as_of.replace(second=0, microsecond=0) + (dt.timedelta(minutes=1) if (as_of.second or as_of.microsecond) else dt.timedelta(0))
        return end - dt.timedelta(days=lookback_days), end
    day = dt.datetime(as_of.year, as_of.month, as_of.day)
    return day - dt.timedelta(days=lookback_days), day


def _ts(v: dt.datetime):
    return F.lit(v.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp")


def present_minutes(fact: DataFrame, start: dt.datetime, end: dt.datetime) -> DataFrame:
    """(symbol_id, minute) of the fact's rows inside the window. The literal bounds reach the
    scan (date-partition pruning / row-group skipping on a stored fact)."""
    if "fact_date" in fact.columns:  # stored fact: prune date partitions too
        fact = fact.filter(F.col("fact_date").between(F.lit(start.date().isoformat()).cast("date"),
                                                      F.lit(end.date().isoformat()).cast("date")))
    return (fact.filter((F.col("timestamp_key") >= _ts(start)) & (F.col("timestamp_key") < _ts(end)))
                .select("symbol_id", F.date_trunc("minute", "timestamp_key").alias("minute")))


def expected_minutes(dim_symbol: DataFrame, start: dt.datetime, end: dt.datetime,
                     num_partitions: int | None = None) -> DataFrame:
    """Every (symbol, minute) of the window, generated per symbol row: days first (a short array),
    then spread over partitions, then 1,440 minutes per day, clipped to the window."""
    n = num_partitions or dim_symbol.sparkSession.sparkContext.defaultParallelism
    days = F.sequence(F.to_date(_ts(start)), F.to_date(_ts(end - dt.timedelta(minutes=1))))
    per_day = (dim_symbol.select("symbol_id", "symbol", F.explode(days).alias("day"))
                         .repartition(n, "symbol_id", "day"))
    minute = F.timestamp_seconds(F.unix_seconds(F.to_timestamp("day")) + F.col("m") * 60)
    return (per_day.select("symbol_id", "symbol", F.explode(F.sequence(F.lit(0), F.lit(1439))).alias("m"), "day")
                   .select("symbol_id", "symbol", minute.alias("minute"))
                   .filter((F.col("minute") >= _ts(start)) & (F.col("minute") < _ts(end))))


def gap_report(fact: DataFrame, dim_symbol: DataFrame, as_of: dt.datetime,
               lookback_days: int = S.GAP_LOOKBACK_DAYS, include_today: bool = False,
               respect_listing: bool = False) -> DataFrame:
    """(symbol, missing_minute) for every expected minute with no fact row.

    Expected rows come from a generator over the symbol dimension, not a cross join; the anti
    join shuffles both sides on (symbol_id, minute), so no symbol concentrates in one task.
    ``respect_listing`` skips minutes before a symbol's tracking start.
    """
    start, end = window_bounds(as_of, lookback_days, include_today)
    exp = expected_minutes(dim_symbol, start, end)
    if respect_listing:
        listing = dim_symbol.select("symbol_id", F.to_timestamp("tracking_start_ts").alias("_listed"))
        exp = (exp.join(listing, "symbol_id")
                  .filter(F.col("_listed").isNull() | (F.col("minute") >= F.col("_listed"))).drop("_listed"))
    missing = exp.join(present_minutes(fact, start, end), ["symbol_id", "minute"], "left_anti")
    return missing.select("symbol", F.col("minute").alias("missing_minute"))


def gap_runs(fact: DataFrame, dim_symbol: DataFrame, as_of: dt.datetime,
             lookback_days: int = S.GAP_LOOKBACK_DAYS, include_today: bool = False) -> DataFrame:
    """Missing minutes folded into runs (symbol, run_start, run_end, n_missing).

    Built from the present minutes only, so the work scales with the data rather than with
    symbols x minutes: each symbol has one mark before and one after the window, and a run is what lies between
    a minute and the next one. One scan, one shuffle by symbol; a symbol has at most the minutes of the window.
    """
    start, end = window_bounds(as_of, lookback_days, include_today)
    s_mi, e_mi = int(start.replace(tzinfo=dt.timezone.utc).timestamp()) // 60, int(end.replace(tzinfo=dt.timezone.utc).timestamp()) // 60
    present = present_minutes(fact, start, end).select("symbol_id", F.floor(F.unix_seconds("minute") / 60).cast("long").alias("mi"), F.lit(None).cast("string").alias("symbol"))
    marks = dim_symbol.select("symbol_id", F.explode(F.array(F.lit(s_mi - 1), F.lit(e_mi)).cast("array<bigint>")).alias("mi"), "symbol")
    by_symbol = Window.partitionBy("symbol_id").orderBy("mi")
    named = F.first("symbol", ignorenulls=True).over(by_symbol)  # the mark comes first; a symbol without one has no name
    runs = present.unionByName(marks).withColumns({"nxt": F.lead("mi").over(by_symbol), "name": named}).filter((F.col("nxt") - F.col("mi") > 1) & F.col("name").isNotNull())
    return runs.select(F.col("name").alias("symbol"), F.timestamp_seconds((F.col("mi") + 1) * 60).alias("run_start"),
                       F.timestamp_seconds((F.col("nxt") - 1) * 60).alias("run_end"), (F.col("nxt") - F.col("mi") - 1).alias("n_missing"))


def gap_report_sparse(fact: DataFrame, dim_symbol: DataFrame, as_of: dt.datetime,
                      lookback_days: int = S.GAP_LOOKBACK_DAYS, include_today: bool = False) -> DataFrame:
    """Same rows as :func:`gap_report`, built from the gap runs: each run expands to its minutes.
    The work follows present and missing minutes instead of the full symbols x minutes matrix,
    which suits large universes with few gaps. A run longer than a day is first cut at day
    boundaries so one row never expands to more than 1,440 minutes."""
    runs = gap_runs(fact, dim_symbol, as_of, lookback_days, include_today)
    day = F.explode(F.sequence(F.to_date("run_start"), F.to_date("run_end"))).alias("day")
    pieces = runs.select("symbol", "run_start", "run_end", day).select(
        "symbol",
        F.greatest(F.col("run_start"), F.to_timestamp("day")).alias("a"),
        F.least(F.col("run_end"), F.to_timestamp("day") + F.expr("INTERVAL 1439 MINUTES")).alias("b"))
    return pieces.select("symbol", F.explode(F.sequence("a", "b", F.expr("INTERVAL 1 MINUTE"))).alias("missing_minute"))
