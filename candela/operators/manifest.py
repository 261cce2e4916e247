"""Backfill planning: which monthly archives exist to fetch, which are landed, and outcome counts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candela import schemas as S
from candela.sources.archives import archive_path


def last_closed_month(as_of: dt.datetime | dt.date) -> dt.date:
    first = dt.date(as_of.year, as_of.month, 1)
    prev = first - dt.timedelta(days=1)
    return dt.date(prev.year, prev.month, 1)


def month_series(listings: DataFrame, as_of: dt.datetime | dt.date, key: str = "symbol",
                 first_col: str = "first_ts", fallback: str = S.LISTING_FALLBACK_BACKFILL) -> DataFrame:
    """One row per (symbol, month) from the listing month to the last fully closed month.

    Symbols listed after that month get no rows (``sequence`` would fail on start > stop); the
    month list per symbol is short (months since listing), generated where the symbol row is.
    """
    stop = F.lit(last_closed_month(as_of).isoformat()).cast("date")
    start = F.trunc(F.coalesce(F.col(first_col).cast("date"), F.lit(fallback).cast("date")), "MM")
    return (listings.select(F.col(key).alias("symbol"), start.alias("_start"))
                    .filter(F.col("_start") <= stop)
                    .select("symbol", F.explode(F.sequence("_start", stop, F.expr("INTERVAL 1 MONTH"))).alias("month_start"))
                    .select("symbol", F.year("month_start").alias("year"), F.month("month_start").alias("month"),
                            archive_path(F.col("symbol"), F.year("month_start"), F.month("month_start")).alias("path")))


def to_fetch(expected: DataFrame, landed: DataFrame) -> DataFrame:
    """Expected months not yet landed (idempotent re-runs skip what is there)."""
    return expected.join(landed.select("symbol", "year", "month"), ["symbol", "year", "month"], "left_anti")


def month_status(expected: DataFrame, landed: DataFrame, available: DataFrame) -> DataFrame:
    """Outcome per expected month: SKIPPED (already landed), else what came of fetching it: the ``status`` that ``available`` gives
    (``archive_outcomes`` of the archives read; SUCCESS where it has no such column), NOT_FOUND (source has no archive for it)."""
    l = landed.select("symbol", "year", "month").withColumn("_landed", F.lit(True))
    got = F.col("status") if "status" in available.columns else F.lit(S.STATUS_SUCCESS)
    a = available.select("symbol", "year", "month", got.alias("_got"))
    j = expected.join(l, ["symbol", "year", "month"], "left").join(a, ["symbol", "year", "month"], "left")
    status = (F.when(F.col("_landed"), F.lit(S.STATUS_SKIPPED))
               .otherwise(F.coalesce("_got", F.lit(S.STATUS_NOT_FOUND))))
    return j.select("symbol", "year", "month", "path", status.alias("status"))


def status_summary(statuses: DataFrame) -> DataFrame:
    """Counts per outcome class (every FAILED variant counts as FAILED)."""
    cls = F.when(F.col("status").startswith(S.STATUS_FAILED), F.lit(S.STATUS_FAILED)).otherwise(F.col("status"))
    return statuses.groupBy(cls.alias("status")).agg(F.count(F.lit(1)).alias("n_tasks"))
