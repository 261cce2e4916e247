"""Symbol metadata document and exchange listing (multi-line JSON documents)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candela import schemas as S


def symbol_records(doc: DataFrame, position: str | None = None) -> DataFrame:
    """``{"symbols": [...]}`` rows -> one row per symbol record, with its place in the document in the column ``position`` if one is named."""
    if position is None:
        return doc.select(F.inline("symbols")).select(*S.SYMBOL_RECORD.fieldNames())
    each = doc.select(F.posexplode("symbols").alias(position, "record"))
    return each.select(position, *(F.col(f"record.{c}").alias(c) for c in S.SYMBOL_RECORD.fieldNames()))


def write_symbol_metadata(records: DataFrame, path: str) -> None:
    """The metadata document: every record in symbol order in one JSON value over several lines. It is one value by its format, so it
    holds what one exchange lists, not market data."""
    whole = records.agg(F.array_sort(F.collect_list(F.struct(*S.SYMBOL_RECORD.fieldNames()))).alias("symbols"))
    whole.select(F.to_json(F.struct("symbols"), {"pretty": "true", "ignoreNullFields": "false"}).alias("value")).write.mode("overwrite").text(path)


def read_symbol_metadata(spark: SparkSession, path: str, position: str | None = None) -> DataFrame:
    """The curated metadata document (explicit schema, no inference)."""
    return symbol_records(spark.read.option("multiLine", True).schema(S.METADATA_SCHEMA).json(path), position)


def read_exchange_listing(spark: SparkSession, path: str) -> DataFrame:
    """Raw exchange listing documents -> one row per listed symbol (exchange field names)."""
    doc = spark.read.option("multiLine", True).schema(S.EXCHANGE_SCHEMA).json(path)
    return doc.select(F.inline("symbols"))
