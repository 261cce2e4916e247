"""Chat formatting by multi-party perspective rotation (numbered operator 2), in DataFrame functions only.

Every participant of a dialogue gets a rendering of its own, in which that speaker is the assistant and the others are users with
their names; context roles (system) are the same for all and take no perspective. The mask is the list of character
spans (start, end) of the assistant's turns, text and end marker, which are what a model is trained on.

Offsets come from a running sum over the turns, so the work is linear in the turns of a rendering; a rendering itself is one row, as a
training example is.

Defined results: turns stand in the order (turn, role, text), nulls first, repeated rows are repeated turns; a null text is empty; a null role
is the participant "unknown"; rows without a conversation id are dialogues of their own (equal ones together); a dialogue of context roles alone has
no rendering; other columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

CONTEXT_ROLES = ("system",)
END = "<|end|>\n"


def rotate(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
           context_roles: tuple[str, ...] = CONTEXT_ROLES) -> DataFrame:
    """conv_id, speaker, n_turns, text, mask (array of (start, end)) for every participant of every dialogue."""
    rows = turns.select(
        F.col(conv_id).alias("conv_id"), F.col(turn).alias("turn"), F.coalesce(F.col(role).cast("string"), F.lit("unknown")).alias("role"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("body"),
        F.when(F.col(conv_id).isNull(), F.xxhash64(turn, role, text)).alias("lone"))
    speaks = ~F.col("role").isin(*context_roles) if context_roles else F.lit(True)
    speakers = rows.filter(speaks).select(F.col("conv_id").alias("c"), F.col("lone").alias("l"), F.col("role").alias("speaker")).distinct()
    same = F.col("conv_id").eqNullSafe(F.col("c")) & F.col("lone").eqNullSafe(F.col("l"))
    seen = rows.join(speakers, same).drop("c", "l")
    own = F.col("role") == F.col("speaker")
    # a name cannot close the marker it stands in
    name = F.translate("role", "<|>\"\n", "")
    head = F.when(own, F.lit("<|assistant|>\n")).when(~speaks, F.concat(F.lit("<|"), name, F.lit("|>\n"))).otherwise(F.concat(F.lit('<|user name="'), name, F.lit('"|>\n')))
    seen = seen.withColumn("head", head).withColumn("own", own).withColumn("segment", F.concat("head", "body", F.lit(END)))
    order = Window.partitionBy("conv_id", "lone", "speaker").orderBy("turn", "role", "body")
    before = F.coalesce(F.sum(F.length("segment")).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).cast("long")
    placed = seen.select("conv_id", "lone", "speaker", "own", "segment", before.alias("at"), F.length("head").alias("skip"), F.row_number().over(order).alias("k"))
    whole = placed.groupBy("conv_id", "lone", "speaker").agg(F.sort_array(F.collect_list(F.struct("k", "at", "skip", "own", "segment"))).alias("t"))
    mask = F.transform(F.filter("t", lambda x: x["own"]), lambda x: F.struct((x["at"] + x["skip"]).alias("start"), (x["at"] + F.length(x["segment"])).alias("end")))
    return whole.select("conv_id", "speaker", F.size("t").cast("long").alias("n_turns"), F.array_join(F.transform("t", lambda x: x["segment"]), "").alias("text"), mask.alias("mask"))


#: The same rendering for tables with unique (conv_id, turn).
ORACLE = """
WITH rows AS (SELECT conv_id, turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS body FROM conversations),
seen AS (
  SELECT r.*, s.speaker, r.role = s.speaker AS own,
         CASE WHEN r.role = s.speaker THEN '<|assistant|>' || chr(10)
              WHEN r.role = 'system' THEN '<|' || r.role || '|>' || chr(10)
              ELSE '<|user name="' || r.role || '"|>' || chr(10) END AS head
  FROM rows r JOIN (SELECT DISTINCT conv_id, role AS speaker FROM rows WHERE role <> 'system') s USING (conv_id)),
seg AS (SELECT *, head || body || '<|end|>' || chr(10) AS segment FROM seen),
placed AS (
  SELECT *, coalesce(sum(length(segment)) OVER (PARTITION BY conv_id, speaker ORDER BY turn, role, body
                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS seg_at FROM seg)
SELECT conv_id, speaker, count(*) AS n_turns, string_agg(segment, '' ORDER BY turn, role, body) AS text,
       coalesce(string_agg(CAST(CAST(seg_at + length(head) AS BIGINT) AS VARCHAR) || '-' || CAST(CAST(seg_at + length(segment) AS BIGINT) AS VARCHAR), ','
                ORDER BY turn, role, body) FILTER (WHERE own), '') AS mask_spans
FROM placed GROUP BY conv_id, speaker
"""
