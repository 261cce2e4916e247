"""The live pipeline: bronze -> silver (clean + quarantine) -> fact -> finalised hourly summary.

    bronze    archive CSV file stream (+ optional broker stream) -> append-only parquet table
    silver    bronze table stream -> stage -> rules -> upsert into ``clean`` / ``quarantine``
    fact      bronze table stream -> stage -> valid final candles -> merge into ``fact``
    hourly    bronze table stream -> ... -> watermark dedup -> dim join -> hourly windows (append)

Each query has its own checkpoint under ``<base>/_checkpoints``; the append-only bronze table is
the hand-over point, so the downstream queries can run on their own schedule
(``available_now=True`` = one scheduled incremental refresh) or continuously.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from candela.operators.bronze import unify
from candela.operators.dims import register_symbols
from candela.operators.fact import final_candles, to_fact
from candela.operators.rules import KLINE_RULES, RuleSet
from candela.operators.stage import stage
from candela.sources.archives import read_csv_archives
from candela.sources.messages import parse_messages
from candela.streaming import runner as ST


@dataclass
class Paths:
    base: str

    def __getattr__(self, name):  # bronze, clean, quarantine, fact, hourly, hourly_all, symbols, deduped, late
        if name.startswith("_"):
            raise AttributeError(name)
        return f"{self.base.rstrip('/')}/{name}"

    def checkpoint(self, name: str) -> str:
        return f"{self.base.rstrip('/')}/_checkpoints/{name}"


def bronze_stream(spark: SparkSession, csv_dir: str, messages: DataFrame | None = None,
                  max_files_per_trigger: int | None = None) -> DataFrame:
    routes = [read_csv_archives(spark, csv_dir, streaming=True, max_files_per_trigger=max_files_per_trigger)]
    if messages is not None:
        routes.append(parse_messages(messages))
    return unify(*routes)


#: Files of the bronze table that one micro-batch takes: the first run over a long history is many bounded batches.
MAX_FILES_PER_TRIGGER = 256


def _bronze_table_stream(spark: SparkSession, paths: Paths, max_files: int = MAX_FILES_PER_TRIGGER) -> DataFrame:
    schema = spark.read.parquet(paths.bronze).schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", str(max_files)).parquet(paths.bronze)


def run_bronze(spark, csv_dir, paths: Paths, messages=None, available_now=True, **kw):
    return ST.run(bronze_stream(spark, csv_dir, messages, kw.pop("max_files_per_trigger", None)),
                  paths.checkpoint("bronze"), sink_path=paths.bronze, available_now=available_now, **kw)


def run_silver(spark, paths: Paths, rules: RuleSet = KLINE_RULES, available_now=True, **kw):
    staged = stage(_bronze_table_stream(spark, paths))
    return ST.run(staged, paths.checkpoint("silver"),
                  foreach_batch=ST.silver_batch_writer(paths.clean, paths.quarantine, rules),
                  available_now=available_now, **kw)


def run_fact(spark, paths: Paths, dim_symbol: DataFrame, rules: RuleSet = KLINE_RULES, available_now=True, **kw):
    valid = rules.valid(stage(_bronze_table_stream(spark, paths)))
    return ST.run(valid, paths.checkpoint("fact"), foreach_batch=ST.fact_batch_writer(paths.fact, dim_symbol, paths.hourly_all),
                  available_now=available_now, **kw)


def run_hourly(spark, paths: Paths, dim_symbol: DataFrame, rules: RuleSet = KLINE_RULES,
               available_now=True, **kw):
    """Live route of the hourly summary: dedup under the 10-minute watermark, then hourly windows
    emitted once that watermark passes the hour's end (one watermark per stream, so the dedup
    bound is also the emission delay). Rows later than the watermark are not in it; ``hourly_all``, made anew from the
    fact for the dates of each fact batch, has them."""
    valid = rules.valid(stage(_bronze_table_stream(spark, paths)))
    fact = to_fact(final_candles(valid), dim_symbol)
    return ST.run(ST.hourly_final(fact, None), paths.checkpoint("hourly"), sink_path=paths.hourly,
                  available_now=available_now, **kw)


def refresh(spark, csv_dir: str, base: str, records: DataFrame, messages=None) -> Paths:
    """One scheduled incremental refresh of every layer. ``records`` are the symbol records known now; their ids come from the
    registry under ``base``, so the stored fact stays keyed when symbols are added."""
    p = Paths(base)
    dim_symbol = register_symbols(p.symbols, records)
    run_bronze(spark, csv_dir, p, messages)
    run_silver(spark, p)
    run_fact(spark, p, dim_symbol)
    run_hourly(spark, p, dim_symbol)
    return p


def run_dedup(spark, source, paths: Paths, available_now=True, **kw):
    """One refresh of the dedup route: final candles, first copy of each under the watermark, into ``deduped``; then the rows that came
    too late for it into ``late``, for the batch backfill (``fact_batch_writer`` merges them by earliest arrival).
    ``source()`` gives the stream of valid candles; both queries read it, each with its own checkpoint."""
    from candela.operators.dedup import DEDUP_KEYS
    ST.run(final_candles(source()), paths.checkpoint("deduped"), sink_path=paths.deduped, available_now=available_now, **kw)
    return ST.run(source().filter("is_final"), paths.checkpoint("late"), available_now=available_now,
                  foreach_batch=ST.divert_late(paths.deduped, paths.late, DEDUP_KEYS, "open_time_ts"), **kw)
