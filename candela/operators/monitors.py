"""Threshold monitors: a filtered count over a recent window compared with a threshold."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candela import schemas as S


@dataclass(frozen=True)
class Monitor:
    name: str
    ts_column: str
    lookback: str          # e.g. "15 minutes", "1 hour"
    threshold: float       # fires when observed > threshold
    severity: str
    predicate: str | None = None   # extra SQL condition on the rows

    def evaluate(self, rows: DataFrame, as_of: dt.datetime) -> DataFrame:
        """One status row. A single global count: partial counts per task, one final row."""
        now = F.lit(as_of.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp")
        cond = F.col(self.ts_column) > now - F.expr(f"INTERVAL {self.lookback}")
        if self.ts_column == "ingestion_timestamp" and "ingest_date" in rows.columns:  # stored by arrival date: prune
            cond = cond & (F.col("ingest_date") >= F.to_date(now - F.expr(f"INTERVAL {self.lookback}")))
        if self.predicate:
            cond = cond & F.expr(self.predicate)
        observed = rows.filter(cond).agg(F.count(F.lit(1)).alias("observed"))
        return observed.select(
            F.lit(self.name).alias("monitor"), F.col("observed"),
            F.lit(float(self.threshold)).alias("threshold"),
            (F.col("observed") > F.lit(float(self.threshold))).alias("triggered"),
            F.lit(self.severity).alias("severity"), F.lit(self.lookback).alias("lookback"))


    def counts_at(self, rows: DataFrame, step: int) -> DataFrame:
        """(at, observed) for every instant, ``step`` seconds apart on the epoch grid, whose look-back holds a row. A row counts at all
        instants t with t - lookback < time <= t; the rows are summed by the first of them, then each sum is added to the others, so
        no row is copied and the window is not scanned once an instant."""
        reach = dt.timedelta(**{unit.rstrip("s") + "s": int(n) for n, unit in [self.lookback.split()]}).total_seconds()
        if reach % step:
            raise ValueError("the look-back must be a multiple of the step")
        seconds = F.unix_micros(self.ts_column) / F.lit(1_000_000 * step)
        first = rows.filter(F.expr(self.predicate) if self.predicate else F.lit(True)).filter(F.col(self.ts_column).isNotNull())
        sums = first.groupBy(F.ceil(seconds).cast("bigint").alias("slot")).agg(F.count(F.lit(1)).alias("n"))
        each = sums.select(F.explode(F.sequence("slot", F.col("slot") + int(reach // step) - 1)).alias("slot"), "n")
        return each.groupBy("slot").agg(F.sum("n").alias("observed")).select(F.timestamp_seconds(F.col("slot") * step).alias("at"), "observed")


_BY_NAME = {name: (lookback, threshold, severity) for name, _, lookback, threshold, severity in S.MONITORS}


def _m(name: str, ts: str, predicate: str | None = None) -> Monitor:
    lookback, threshold, severity = _BY_NAME[name]
    return Monitor(name, ts, lookback, threshold, severity, predicate)


SCHEMA_DRIFT = _m("schema_drift", "ingestion_timestamp", f"{S.RESCUE_COLUMN} IS NOT NULL")
QUARANTINE = _m("quarantine", "ingestion_timestamp")
MISSING_MINUTES = _m("missing_minutes", "missing_minute")


def evaluate_all(bronze: DataFrame, quarantine: DataFrame, gaps: DataFrame, as_of: dt.datetime) -> DataFrame:
    """The three standard monitors as one alert-status table."""
    return (SCHEMA_DRIFT.evaluate(bronze, as_of)
            .unionByName(QUARANTINE.evaluate(quarantine, as_of))
            .unionByName(MISSING_MINUTES.evaluate(gaps, as_of)))


def history(sources: list[tuple[Monitor, DataFrame]], start: dt.datetime, end: dt.datetime, step: int = 300) -> DataFrame:
    """What each monitor said at every evaluation instant in [start, end] (``step`` seconds apart): one job over each table, not one
    evaluation an instant. Instants without rows are there, with nothing observed."""
    spark = sources[0][1].sparkSession
    epoch = lambda t: int((t - dt.datetime(1970, 1, 1)).total_seconds())
    lo, hi = -(-epoch(start) // step), epoch(end) // step
    out = None
    for m, rows in sources:
        instants = spark.range(lo, hi + 1).select(F.timestamp_seconds(F.col("id") * step).alias("at"))
        seen = instants.join(m.counts_at(rows, step), "at", "left").select(
            F.lit(m.name).alias("monitor"), F.col("at").alias("as_of"), F.coalesce("observed", F.lit(0)).alias("observed"),
            F.lit(float(m.threshold)).alias("threshold"), F.lit(m.severity).alias("severity"))
        seen = seen.withColumn("triggered", F.col("observed") > F.col("threshold"))
        out = seen if out is None else out.unionByName(seen)
    return out
