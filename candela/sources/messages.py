"""Live candle messages (JSON text, e.g. the ``value`` of a message-broker source) -> bronze rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from candela import schemas as S

# Keys a well-formed message may carry that we do not read; anything else is schema drift.
KNOWN_TOP_KEYS = ["e", "E", "s", "k"]
KNOWN_CANDLE_KEYS = [short for short, _, _ in S.MESSAGE_FIELDS] + ["s", "i", "f", "L", "B"]


CANDLE_LONG = StructType([StructField(long, f.dataType, True)
                          for (_, long, _), f in zip(S.MESSAGE_FIELDS, S.MESSAGE_SCHEMA["k"].dataType.fields)])


def broker_options(bootstrap: str, topic: str, max_offsets: int = S.MAX_OFFSETS_PER_TRIGGER,
                   starting: str = "latest", fail_on_data_loss: bool = False, extra: dict | None = None) -> dict:
    """Options for ``spark.readStream.format("kafka")``: rate-limited. With ``fail_on_data_loss`` off, offsets the
    broker has already deleted are skipped: the query goes on, and those rows are missing.

    Credentials (SASL and the like) are deployment settings; pass them through ``extra``.
    """
    opts = {
        "kafka.bootstrap.servers": bootstrap,
        "subscribe": topic,
        "maxOffsetsPerTrigger": str(max_offsets),
        "failOnDataLoss": str(fail_on_data_loss).lower(),
        "startingOffsets": starting,
    }
    opts.update(extra or {})
    return opts


def drift_keys(payload: Column) -> Column:
    """JSON keys outside the schema (top level and inside the candle), NULL for malformed text."""
    top = F.array_except(F.json_object_keys(payload), F.array(*[F.lit(k) for k in KNOWN_TOP_KEYS]))
    inner = F.array_except(F.coalesce(F.json_object_keys(F.get_json_object(payload, "$.k")),
                                      F.array().cast("array<string>")),
                           F.array(*[F.lit(k) for k in KNOWN_CANDLE_KEYS]))
    return F.concat(top, inner)


def parse_messages(df: DataFrame, value: str = "value", ingestion: Column | None = None,
                   source_system: str = S.SOURCE_STREAM) -> DataFrame:
    """Parse candle messages into the bronze shape.

    ``value`` may be binary (broker) or string. Field names are case-sensitive (``t``/``T``,
    ``v``/``V``, ``q``/``Q``); ``from_json`` with an explicit schema resolves them by exact
    name, so no session-wide case-sensitivity switch is needed. Malformed text parses to all
    NULL and is rescued whole. ``raw_payload`` keeps every message; ``_rescued_data`` is set
    only on drift (unknown keys) or malformed text.
    """
    text = F.col(value).cast("string")
    parsed = df.select(
        text.alias("_payload"),
        F.from_json(text, S.MESSAGE_SCHEMA).alias("_m"),
        (ingestion if ingestion is not None else F.current_timestamp()).alias("ingestion_timestamp"),
    )
    # The candle struct is cast by position to long field names: t/T, v/V, q/Q never have to be
    # resolved by name, so no session-wide case-sensitivity switch is needed.
    parsed = parsed.withColumn("_k", F.col("_m.k").cast(CANDLE_LONG))
    cols = [F.col("_m.s").alias("symbol")]
    cols += [F.col(f"_k.{long}").alias(long) for _, long, _ in S.MESSAGE_FIELDS]
    drift = drift_keys(F.col("_payload"))
    malformed = F.col("_m").isNull() | (F.col("_m.s").isNull() & F.col("_m.k").isNull())
    return parsed.select(
        *cols,
        "ingestion_timestamp",
        F.lit(source_system).alias("source_system"),
        F.lit(S.STREAM_SOURCE_FILE).alias("source_file"),
        F.col("_payload").alias("raw_payload"),
        F.when(malformed | (F.size(drift) > 0), F.col("_payload")).alias(S.RESCUE_COLUMN),
    )
