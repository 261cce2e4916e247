"""Star-schema dimensions: symbols and minutes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candela import schemas as S
from candela.functions.columns import time_parts
from candela.functions.ids import dense_sequence_id, stable_hash_id
from candela.session import table_exists

SYMBOL_COLUMNS = [f.name for f in S.SYMBOL_RECORD.fields]


def dim_symbol(records: DataFrame, id_mode: str = "sequence") -> DataFrame:
    """Symbol dimension from symbol records (one row per symbol).

    ``id_mode="sequence"``: symbol_id = position in symbol order (1, 2, ...), computed without a
    single-task window. ``id_mode="hash"``: a 64-bit hash of the symbol, which stays the same
    when symbols are added (sequence ids shift; stored fact rows would keep the old ids).
    """
    base = records.select(*SYMBOL_COLUMNS)
    if id_mode == "hash":
        return base.withColumn("symbol_id", stable_hash_id(F.col("symbol")))
    return dense_sequence_id(base, ["symbol"], "symbol_id")


def register_symbols(registry: str, records: DataFrame) -> DataFrame:
    """Symbol dimension whose ids never change: (symbol, symbol_id) rows are kept in an append-only table at ``registry``;
    symbols seen for the first time get the next ids, in symbol order. A stored fact stays keyed when symbols are added.
    One writer at a time."""
    spark = records.sparkSession
    schema = "symbol string, symbol_id int"
    known = spark.read.schema(schema).parquet(registry) if table_exists(spark, registry) else spark.createDataFrame([], schema)
    top = known.agg(F.coalesce(F.max("symbol_id"), F.lit(0)).alias("top")).first()["top"]
    fresh = records.select("symbol").filter("symbol IS NOT NULL").distinct().join(known, "symbol", "left_anti")
    ids = dense_sequence_id(fresh, ["symbol"], "symbol_id").withColumn("symbol_id", (F.col("symbol_id") + top).cast("int"))
    ids.write.mode("append").parquet(registry)
    return records.select(*SYMBOL_COLUMNS).join(spark.read.schema(schema).parquet(registry), "symbol").select(*SYMBOL_COLUMNS, "symbol_id")


def minute_series(spark: SparkSession, start: str, end: str, name: str = "timestamp_key",
                  num_partitions: int | None = None) -> DataFrame:
    """Every minute from start to end inclusive, generated in parallel (``range``, not a literal
    array: a ``sequence`` of literals is folded into one huge constant in one row)."""
    bounds = spark.sql(f"SELECT unix_seconds(timestamp'{start}') AS s, unix_seconds(timestamp'{end}') AS e").first()
    n = (bounds.e - bounds.s) // 60 + 1
    parts = num_partitions or int(n // 500_000) + 1
    return spark.range(0, n, 1, parts).select(F.timestamp_seconds(F.lit(bounds.s) + F.col("id") * 60).alias(name))


def dim_time_rows(minutes: DataFrame, ts: str = "timestamp_key") -> DataFrame:
    return minutes.select(F.col(ts).alias("timestamp_key"), *time_parts(F.col(ts)))


def dim_time(spark: SparkSession, start: str = S.DIM_TIME_START, end: str = S.DIM_TIME_END) -> DataFrame:
    """Minute-grain time dimension (4,953,601 rows for the default span)."""
    return dim_time_rows(minute_series(spark, start, end))


def dim_time_covering(df: DataFrame, ts: str, num_partitions: int | None = None) -> DataFrame:
    """Time dimension covering whole UTC days from the first to the last day of ``df[ts]``.

    Derived without collecting: one bounds row -> its days (one row per day) -> spread over
    partitions -> 1,440 minutes per day.
    """
    n = num_partitions or df.sparkSession.sparkContext.defaultParallelism
    days = (df.agg(F.min(F.to_date(ts)).alias("d0"), F.max(F.to_date(ts)).alias("d1"))
              .filter(F.col("d0").isNotNull())
              .select(F.explode(F.sequence("d0", "d1")).alias("day"))
              .repartition(n))
    minutes = days.select(
        F.explode(F.sequence(F.lit(0), F.lit(1439))).alias("m"), "day"
    ).select(F.timestamp_seconds(F.unix_seconds(F.to_timestamp("day")) + F.col("m") * 60).alias("timestamp_key"))
    return dim_time_rows(minutes)
