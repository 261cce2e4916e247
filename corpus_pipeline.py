"""The corpus pipeline: quality rules, line dedup, near-duplicate removal, benchmark decontamination, tokens.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet
and read again as the next one's docs. All but the last return the columns of ``documents``; ``n_chars`` follows the text. Null,
empty and repeated rows and extra columns are treated as the operators' docstrings say; an empty table gives no rows.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candela.llm import bpe, decontaminate, linedup, neardup, quality
from candela.llm.stages import table, written
from candela.session import apply_sql_conf

#: After line dedup a document goes if lines were taken out and less than this share of its characters is left.
LEAST_LEFT = 0.2
#: Documents whose sets of five-word shingles have this Jaccard similarity or more are near-duplicates.
NEAR_PERCENT = 80


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a quality rule rejects go."""
    apply_sql_conf(spark)
    judged = quality.judge(docs, prefix="__quality_", measures=False)
    return judged.filter("__quality_kept").select(docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that repeat an earlier one go; so do documents of which little is left."""
    apply_sql_conf(spark)
    had = docs.withColumn("__had", F.length("text"))
    whole = F.col("__line_n_dropped") == 0
    left = linedup.dedup_lines(had, prefix="__line_").filter(whole | (F.length("text") >= F.lit(LEAST_LEFT) * F.col("__had")))
    if "n_chars" in docs.columns:
        left = left.withColumn("n_chars", F.when(whole, F.col("n_chars")).otherwise(F.length("text")).cast(docs.schema["n_chars"].dataType))
    return left.select(docs.columns)


def minhash_neardup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    apply_sql_conf(spark)
    return neardup.first_of_each(docs, percent=NEAR_PERCENT)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    apply_sql_conf(spark)
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``n_tokens`` and ``ids`` of every text (``bpe_n_tokens``, ``bpe_ids`` where a column of the documents has that name); ``text`` is
    what they decode to."""
    apply_sql_conf(spark)
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    both = bpe.decode(bpe.encode(docs, path, ids="__ids"), path, ids="__ids", out="__decoded")
    text = F.when(F.col("text").isNotNull(), F.col("__decoded").cast("string")).alias("text")
    name = lambda c: f"bpe_{c}" if c in docs.columns else c
    return both.select(*(text if c == "text" else F.col(f"`{c}`") for c in docs.columns), F.size("__ids").cast("long").alias(name("n_tokens")), F.col("__ids").alias(name("ids")))


STAGES = [("quality_rules", quality_rules), ("line_dedup", line_dedup), ("minhash_neardup", minhash_neardup),
          ("benchmark_decontamination", benchmark_decontamination), ("byte_bpe", byte_bpe)]

#: Line dedup, components of near-duplicates and BPE have no SQL; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
