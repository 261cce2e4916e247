"""Queries of the numbered operators over whole tables; each takes (spark, sf_dir)."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candela.llm.stages import table


def op1_decontaminate(spark: SparkSession, d: str) -> DataFrame:
    from candela.llm.decontaminate import contamination
    found = contamination(table(spark, d, "documents"), table(spark, d, "benchmark"))
    return found.select(F.col("id").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op2_chat_rotation(spark: SparkSession, d: str) -> DataFrame:
    from candela.llm.chat import rotate
    spans = F.transform("mask", lambda x: F.concat(x["start"].cast("string"), F.lit("-"), x["end"].cast("string")))
    return rotate(table(spark, d, "conversations")).withColumn("mask_spans", F.array_join(spans, ",")).drop("mask")


def op3_elias_fano_ids(spark: SparkSession, d: str) -> DataFrame:
    from candela.llm.idstore import stored_ids
    return stored_ids(table(spark, d, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op4_minhash_neardup(spark: SparkSession, d: str) -> DataFrame:
    from candela.llm.neardup import near_duplicates
    found = near_duplicates(table(spark, d, "documents"))
    return found.select(F.col("id").alias("doc_id"), "n_shingles", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))


def op5_hypergeometric_shards(spark: SparkSession, d: str) -> DataFrame:
    from candela.llm.shards import shuffle_into_shards
    text = F.coalesce("text", F.lit(""))
    out = shuffle_into_shards(table(spark, d, "documents").select("doc_id", "text"))
    return out.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"), F.lit("rows").alias("law"),
                      "shard", F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


def op6_quality_rules(spark: SparkSession, d: str) -> DataFrame:
    from candela.llm.quality import judge
    return judge(table(spark, d, "documents").select("doc_id", "text")).drop("text")


def op7_line_dedup(spark: SparkSession, d: str) -> DataFrame:
    from candela.llm.linedup import dedup_lines
    return dedup_lines(table(spark, d, "documents").select("doc_id", "text"))


def op8_html_main_text(spark: SparkSession, d: str) -> DataFrame:
    from candela.llm.mainhtml import extract
    return extract(table(spark, d, "pages").select("page_id", "url", "html")).withColumn("n_chars", F.length("text").cast("long"))


def op9_byte_bpe(spark: SparkSession, d: str) -> DataFrame:
    from candela.llm.bpe import decode, digests, encode
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    both = decode(encode(table(spark, d, "documents").select("doc_id", "text"), path), path)
    return both.select("doc_id", *digests(both))


def op10_pitman_yor_scores(spark: SparkSession, d: str) -> DataFrame:
    from candela.llm.pitman import score
    return score(table(spark, d, "documents")).withColumnRenamed("id", "doc_id")


def op11_hard_negatives(spark: SparkSession, d: str) -> DataFrame:
    from candela.llm.hardneg import hard_negatives
    noisy = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(table(spark, d, "embeddings").withColumn("label", noisy), F.col("vec_id") % 50 == 0)


def op12_vector_neardup(spark: SparkSession, d: str) -> DataFrame:
    from candela.llm.vecdup import near_vectors
    found = near_vectors(table(spark, d, "embeddings"))
    return found.select(F.col("id").alias("vec_id"), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))


def op13_merkle_manifest(spark: SparkSession, d: str) -> DataFrame:
    from candela.llm.merkle import audited
    return audited(table(spark, d, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
    op1_decontaminate, op2_chat_rotation, op3_elias_fano_ids, op4_minhash_neardup, op5_hypergeometric_shards, op6_quality_rules,
    op7_line_dedup, op8_html_main_text, op9_byte_bpe, op10_pitman_yor_scores, op11_hard_negatives, op12_vector_neardup,
    op13_merkle_manifest)}


def _oracles() -> dict[str, str]:
    from candela.llm import chat, hardneg, merkle, oracles, vecdup
    return {"op1_decontaminate": oracles.DECONTAMINATE, "op2_chat_rotation": chat.ORACLE, "op4_minhash_neardup": oracles.NEARDUP, "op6_quality_rules": oracles.QUALITY,
            "op7_line_dedup": oracles.LINES, "op11_hard_negatives": hardneg.ORACLE, "op12_vector_neardup": vecdup.ORACLE, "op13_merkle_manifest": merkle.ORACLE}


ORACLES: dict[str, str] = _oracles()
