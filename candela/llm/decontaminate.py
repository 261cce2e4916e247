"""Benchmark decontamination as a prefix-filtered set join (numbered operator 1).

A benchmark item gives windows of ``window`` consecutive words (a shorter item is one window). A document contains a
window only if it contains all of the window's word shingles, so the join needs just one of them per
window: shingles are ordered by how often the corpus has them, and the necessary prefix of a containment of 1 is the
rarest. Steps:

1. windows and their shingles from the benchmark;
2. corpus counts of the benchmark's shingles (one pass over the documents, summed in Spark);
3. the prefix token of each distinct window; a window with a shingle that no document has is dropped, as it cannot occur;
4. a second pass emits the places of prefix tokens with the words around them; a join with the windows applies the
   length and positional bounds and verifies the words themselves.

The passes filter shingles by a bitmap of fixed size (2 MB) whatever the benchmark holds; false hits
only cost a row that the join drops. Joins and counts are Spark's, so neither side has to fit a task.

Defined results: null, empty and wordless texts have no words and no hits; null item texts give no windows; repeated items
with one id count once; null item ids mark words but are not listed; rows with equal id and text get equal results; an empty table on
either side gives no hits. Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from candela.llm import bitmap
from candela.llm import textkit as K
from candela.llm.stages import written

WINDOW = 10
GRAM = 3


def _windows(bench: DataFrame, id_col: str, text_col: str, window: int) -> DataFrame:
    """item_id, window text, n words, hashes of its shingles (of GRAM words, or all its words if fewer)."""
    items = bench.select(F.col(id_col).cast("string").alias("item_id"), K.text_column(bench, text_col).alias("text"))

    def run(batches):
        for batch in batches:
            for part in K.chunks(batch, "text"):
                w = K.words(part.column("text"), K.ALNUM_WORD, lower=True)
                by_k = {k: w.grams(k)[0].astype(np.int64) for k in range(1, GRAM + 1)}
                out = []
                for row, item in enumerate(part.column("item_id").to_pylist()):
                    lo, hi = int(w.first[row]), int(w.first[row + 1])
                    n = min(window, hi - lo)
                    if not n:
                        continue
                    k = min(GRAM, n)
                    for i in range(lo, hi - n + 1):
                        out.append({"item_id": item, "wtext": w.text(i, i + n), "n": n, "grams": by_k[k][i:i + n - k + 1].tolist()})
                if out:
                    yield pa.RecordBatch.from_pylist(out, schema=pa.schema([("item_id", pa.string()), ("wtext", pa.string()), ("n", pa.int32()), ("grams", pa.list_(pa.int64()))]))

    return items.mapInArrow(K.handing_back(run), "item_id string, wtext string, n int, grams array<bigint>")


def _corpus_counts(docs: DataFrame, bits) -> DataFrame:
    def run(batches):
        for batch in batches:
            for part in K.chunks(batch, "text"):
                w = K.words(part.column("text"), K.ALNUM_WORD, lower=True)
                for k in range(1, GRAM + 1):
                    g, ok = w.grams(k)
                    h, c = np.unique(g[ok & bitmap.holds(bits.value, g)], return_counts=True)
                    if len(h):
                        yield pa.RecordBatch.from_arrays([pa.array(h.astype(np.int64)), pa.array(c.astype(np.int64))], names=["gram", "df"])
    return docs.select("text").mapInArrow(K.handing_back(run), "gram bigint, df bigint").groupBy("gram").agg(F.sum("df").alias("df"))


def _places(docs: DataFrame, bits, window: int) -> DataFrame:
    """One row per document (gram null) and one per place of a possible prefix token, with the words around it."""
    def run(batches):
        for batch in batches:
            for part in K.chunks(batch, "text"):
                w = K.words(part.column("text"), K.ALNUM_WORD, lower=True)
                ids, keys, n_words = part.column("id"), part.column("key"), np.diff(w.first)
                none = pa.nulls(part.num_rows, pa.int64())
                yield pa.RecordBatch.from_arrays([ids, keys, pa.array(n_words), none, pa.nulls(part.num_rows, pa.int64()), pa.nulls(part.num_rows, pa.int64()), pa.nulls(part.num_rows, pa.string())],
                                                 names=["id", "key", "n_words", "gram", "pos", "ctx_from", "ctx"])
                row = w.row_of_word()
                for k in range(1, GRAM + 1):
                    g, ok = w.grams(k)
                    at = np.flatnonzero(ok & bitmap.holds(bits.value, g))
                    if not len(at):
                        continue
                    r = row[at]
                    lo = np.maximum(w.first[r], at - (window - 1))
                    hi = np.minimum(w.first[r + 1], at + window)
                    ctx = [w.text(i, j) for i, j in zip(lo, hi)]
                    take = pa.array(r)
                    yield pa.RecordBatch.from_arrays([ids.take(take), keys.take(take), pa.array(n_words[r]), pa.array(g[at].astype(np.int64)), pa.array(at - w.first[r]), pa.array(lo - w.first[r]), pa.array(ctx, pa.string())],
                                                     names=["id", "key", "n_words", "gram", "pos", "ctx_from", "ctx"])
    return docs.mapInArrow(K.handing_back(run), "id bigint, key bigint, n_words bigint, gram bigint, pos bigint, ctx_from bigint, ctx string")


def find_windows(docs: DataFrame, bench: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
                 item_text: str = "text", window: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """(documents, hits): ``documents`` has id, key, n_words for every row; ``hits`` has id, key, start, n and item_id
    for each distinct place of an item's window (``key`` is a hash of the text)."""
    docs = docs.select(F.col(doc_id).cast("long").alias("id"), F.xxhash64(K.text_column(docs, text)).alias("key"), K.text_column(docs, text).alias("text"))
    items = written(_windows(bench, item_id, item_text, window), "op1-windows")
    distinct = items.groupBy("wtext", "n").agg(F.any_value("grams").alias("grams"))
    shingles = distinct.select("wtext", "n", F.posexplode("grams").alias("offset", "gram"))

    bits = bitmap.build(shingles, "gram")
    counts = _corpus_counts(docs, bits)
    ranked = shingles.join(counts, "gram", "left").groupBy("wtext", "n").agg(
        F.min(F.struct(F.coalesce("df", F.lit(0)).alias("df"), "gram", "offset")).alias("rarest"))
    prefix = written(ranked.filter("rarest.df > 0").select("wtext", "n", "rarest.gram", "rarest.offset"), "op1-prefix")

    bits2 = bitmap.build(prefix, "gram")
    places = written(_places(docs, bits2, window), "op1-places")
    found = places.filter(F.col("gram").isNotNull()).join(prefix, "gram")
    start = F.col("pos") - F.col("offset")
    found = (found.withColumn("start", start)
             .filter((F.col("start") >= 0) & (F.col("start") + F.col("n") <= F.col("n_words")) & (F.col("start") >= F.col("ctx_from")))
             .filter(F.array_join(F.slice(F.split("ctx", " "), (F.col("start") - F.col("ctx_from") + 1).cast("int"), F.col("n")), " ") == F.col("wtext"))
             .select("id", "key", "start", "n", "wtext").distinct())
    hits = found.join(items.select("wtext", "item_id").distinct(), "wtext").drop("wtext")
    return places.filter(F.col("gram").isNull()).select("id", "key", "n_words"), hits


def contamination(docs: DataFrame, bench: DataFrame, **kw) -> DataFrame:
    """One row per document row: id, key, n_words, n_hit (words inside any window found) and the
    sorted ids of the items found."""
    documents, hits = find_windows(docs, bench, **kw)
    hits = written(hits, "op1-hits")
    # words hit: spans in order, each adding what reaches beyond the furthest end so far
    spans = hits.select("id", "key", "start", (F.col("start") + F.col("n")).alias("stop")).distinct()
    before = Window.partitionBy("id", "key").orderBy("start", "stop").rowsBetween(Window.unboundedPreceding, -1)
    reach = F.coalesce(F.max("stop").over(before), F.lit(0))
    n_hit = (spans.withColumn("more", F.greatest(F.lit(0), F.col("stop") - F.greatest("start", reach)))
             .groupBy("id", "key").agg(F.sum("more").alias("n_hit")))
    items = hits.groupBy("id", "key").agg(F.sort_array(F.collect_set("item_id")).alias("items"))
    both = (n_hit.withColumnRenamed("id", "hit_id").withColumnRenamed("key", "hit_key")
            .join(items, F.col("hit_id").eqNullSafe(F.col("id")) & (F.col("hit_key") == F.col("key"))).drop("id", "key"))
    return (documents.join(both, F.col("hit_id").eqNullSafe(F.col("id")) & (F.col("hit_key") == F.col("key")), "left").drop("hit_id", "hit_key")
            .withColumn("n_hit", F.coalesce("n_hit", F.lit(0)).cast("long"))
            .withColumn("items", F.coalesce("items", F.array().cast("array<string>"))))


def clean(docs: DataFrame, bench: DataFrame, doc_id: str = "doc_id", text: str = "text", **kw) -> DataFrame:
    """``docs`` without the rows that hold a window of the benchmark; columns as they came."""
    documents, hits = find_windows(docs, bench, doc_id=doc_id, text=text, **kw)
    bad = hits.select(F.col("id").alias("__bad_id"), F.col("key").alias("__bad_key")).distinct()
    same = F.col(doc_id).cast("long").eqNullSafe(F.col("__bad_id")) & (F.xxhash64(K.text_column(docs, text)) == F.col("__bad_key"))
    return docs.join(bad, same, "left_anti")
