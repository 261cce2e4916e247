"""A Merkle manifest of a table, one tree a group under one root (numbered operator 13).

A leaf is the SHA-256 of a row's fields (``-`` for null, else UTF-8 length, ``:``, value). In a group leaves ascend by id; every two
consecutive nodes (the last one alone where it is left over) become the digest of their hex texts until one is left, the group's
subroot; subroots by group (null first, then bytewise) give the root the same way.

1. Bitmap directory. Every task or-s the ids of a group into 64-bit words; words merge by key across tasks, and empty words are not
   stored, so a bitmap takes at most a word an id. Running popcounts are kept as a tree: sums over FANOUT words, over FANOUT of
   these, and so on, so no window holds more than FANOUT rows, however large the group.
2. Rank. A row's leaf coordinate is its word's running count plus the bits below its own: an equi-join on (group, word) and one
   popcount. Rows are not sorted.
3. Slot arrays. Rows go by (group, coordinate / SLOTS) into arrays of SLOTS slots; LEVELS levels are reduced inside an array, its
   last node is a slot of the next array level, until each group, and then the table, has one node.
4. Paths. From the top down every array hands the siblings above it to the arrays below, one row an array; leaves get theirs in the last step.

Defined results: rows with a null id come before the others of their group, equal ids ascend by leaf digest (identical rows have
interchangeable places); these alone, whose word holds more rows than bits, are numbered by a range-partitioned sort. A null
group is a group. An empty table gives an empty result. Clashing columns: only the named fields are read, all else is ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candela.llm.stages import written

LEVELS = 10
SLOTS = 1 << LEVELS
FANOUT_BITS = 14
#: The word of null ids: one below the least id's.
NULL_WORD = -(1 << 57) - 1


def field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def digest(*values: Column) -> Column:
    """Lowercase hex SHA-256 of the fields, concatenated."""
    return F.sha2(F.concat(*(field(v) for v in values)), 256)


def group_key(group: Column) -> Column:
    """Never null; sorts as the groups do, null first."""
    return F.coalesce(F.concat(F.lit("="), group.cast("string")), F.lit(""))


def directory(rows: DataFrame) -> DataFrame:
    """(k, word, bits, rows, before, total) of rows with k and id: the non-empty bitmap words of each group, how many rows a word
    has and how many of the group stand before it, and how many the group has."""
    bit = F.expr("shiftleft(1L, cast(id & 63 as int))")
    words = rows.groupBy("k", _word().alias("word")).agg(F.bit_or(bit).alias("bits"), F.count("*").alias("rows"))
    words = written(words, "op13-words")
    levels = [words.select("k", F.col("word").alias("w0"), "rows")]
    while len(levels) * FANOUT_BITS < 58:
        i = len(levels)
        levels.append(levels[-1].groupBy("k", F.shiftright(f"w{i - 1}", FANOUT_BITS).alias(f"w{i}")).agg(F.sum("rows").alias("rows")))
    top = len(levels) - 1
    before = F.coalesce(F.sum("rows").over(Window.partitionBy("k").orderBy(f"w{top}").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counted = levels[top].withColumn("before", before).withColumn("total", F.sum("rows").over(Window.partitionBy("k")))
    for i in range(top - 1, -1, -1):
        up = F.shiftright(f"w{i}", FANOUT_BITS)
        within = F.sum("rows").over(Window.partitionBy("k", f"w{i + 1}").orderBy(f"w{i}").rowsBetween(Window.unboundedPreceding, -1))
        own = levels[i].withColumn(f"w{i + 1}", up).withColumn("within", F.coalesce(within, F.lit(0)))
        counted = own.join(counted.select("k", f"w{i + 1}", "before", "total"), ["k", f"w{i + 1}"]).select(
            "k", f"w{i}", "rows", (F.col("before") + F.col("within")).alias("before"), "total")
    counted = counted.select("k", F.col("w0").alias("word"), "before", "total")
    return words.join(counted, ["k", "word"])


def _word() -> Column:
    return F.coalesce(F.shiftright("id", 6), F.lit(NULL_WORD))


def coordinates(rows: DataFrame, words: DataFrame) -> DataFrame:
    """``rows`` (k, id, leaf, ...) with ``at``, the 0-based place in the group, and ``total``."""
    below = F.expr("~shiftleft(-1L, cast(id & 63 as int))")
    met = rows.withColumn("word", _word()).join(words.withColumnRenamed("rows", "in_word"), ["k", "word"])
    single = F.col("in_word") == F.coalesce(F.bit_count("bits"), F.lit(0))
    rank = F.col("before") + F.bit_count(F.col("bits").bitwiseAND(below))
    drop = ("word", "bits", "in_word", "before")
    plain = met.filter(single).withColumn("at", rank).drop(*drop)
    crowded = words.filter(F.col("rows") != F.coalesce(F.bit_count("bits"), F.lit(0)))
    if not crowded.head(1):
        return plain
    # words with repeated or null ids: a range sort over (word, id, digest), identical rows spread by a stored random number
    odd = written(met.filter(~single).withColumn("spread", F.rand(13)), "op13-odd")
    order = [F.col("k"), F.col("word"), F.col("id").asc_nulls_first(), F.col("leaf"), F.col("spread")]
    ranged = written(odd.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "op13-ranged")
    sizes = ranged.groupBy("part").agg(F.count("*").alias("size"))
    offset = sizes.select("part", F.coalesce(F.sum("size").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("offset"))
    placed = ranged.withColumn("place", F.row_number().over(Window.partitionBy("part").orderBy(*order))).join(offset, "part")
    placed = placed.withColumn("place", F.col("place") + F.col("offset")).drop("part", "offset", "spread")
    first = placed.groupBy("k", "word").agg(F.min("place").alias("start"))
    numbered = placed.join(first, ["k", "word"]).withColumn("at", F.col("before") + F.col("place") - F.col("start")).drop("place", "start", *drop)
    return plain.unionByName(numbered)


_PAIRED = "transform(sequence(0, shiftright(size({x}) - 1, 1)), i -> sha2(concat(get({x}, 2 * i), coalesce(get({x}, 2 * i + 1), '')), 256))"
#: All node levels of an array of ``slots``, the leaves first.
_LEVELS = ("aggregate(if(height > 0, sequence(1, height), array()), array(slots.digest), "
           "(done, l) -> concat(done, array(" + _PAIRED.format(x="element_at(done, -1)") + ")))")
#: What stands beside the path from slot ``i`` up: '<' or '>' (left or right of it) and the digest, or nothing.
_BESIDE = ("transform(if(height > 0, sequence(0, height - 1), array()), l -> if(shiftright(i, l) & 1 = 1, "
           "concat('<', get(get(levels, l), shiftright(i, l) - 1)), coalesce(concat('>', get(get(levels, l), shiftright(i, l) + 1)), '')))")


def slot_arrays(nodes: DataFrame) -> DataFrame:
    """Nodes (k, at, total, digest, ...) by (k, block) in arrays of up to SLOTS slots ordered by place, with the number of levels to reduce."""
    rest = [c for c in nodes.columns if c not in ("k", "at", "total")]
    arrays = nodes.groupBy("k", F.shiftright("at", LEVELS).alias("block")).agg(
        F.any_value("total").alias("total"), F.array_sort(F.collect_list(F.struct("at", *rest))).alias("slots"))
    height = F.when(F.col("total") > 1, F.least(F.length(F.bin(F.col("total") - 1)), F.lit(LEVELS))).otherwise(0)
    return arrays.withColumn("height", height)


def _levels(arrays: DataFrame) -> DataFrame:
    return arrays.withColumn("levels", F.expr(_LEVELS))


def _above(arrays: DataFrame) -> DataFrame:
    """Each array's last node as a node of the next level."""
    return _levels(arrays).select("k", F.col("block").alias("at"), F.ceil(F.col("total") / SLOTS).alias("total"), F.expr("get(element_at(levels, -1), 0)").alias("digest"))


def _reduced(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """The stored array levels of a forest, and its roots (k, digest)."""
    stages = []
    while True:
        stages.append(written(slot_arrays(nodes), f"op13-slots{len(stages)}"))
        most = stages[-1].agg(F.max("total").alias("most")).first()["most"]
        nodes = _above(stages[-1])
        if (most or 1) <= SLOTS:
            return stages, nodes.select("k", "digest")


def _paths(stages: list[DataFrame], above: DataFrame) -> DataFrame:
    """Nodes of the lowest level with ``path``: what ``above`` (k, path, ...) has for their tree, after what stands beside them in it."""
    kept = [c for c in above.columns if c not in ("k", "path")]
    over = above.withColumn("block", F.lit(0).cast("bigint"))
    for arrays in reversed(stages):
        met = _levels(arrays).join(over, ["k", "block"])
        each = met.select("k", "height", "levels", "path", *kept, F.posexplode("slots").alias("i", "slot"))
        low = each.select("k", F.concat(F.expr(_BESIDE), "path").alias("path"), *kept, "slot")
        over = low.select("k", "path", *kept, F.col("slot.at").alias("block"))
    return low


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and the digests beside its path give."""
    other = lambda s: F.substring(s, 2, 64)
    return F.aggregate(path, leaf, lambda node, s: F.sha2(
        F.when(s.startswith("<"), F.concat(other(s), node)).when(s.startswith(">"), F.concat(node, other(s))).otherwise(node), 256))


def path_digest(path: Column) -> Column:
    """The SHA-256 of the digests beside a path, joined in order."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.substring(s, 2, 64)), ""), 256)


def manifest(docs: DataFrame, id_col: str, group_col: str, fields: Sequence[str], carry: dict[str, Column] | None = None) -> DataFrame:
    """One row per row of ``docs``: id, leaf, path (array, bottom-up), subroot and root, and the columns of ``carry``, computed beside the leaf."""
    key = group_key(F.col(f"`{group_col}`"))
    number = F.col(f"`{id_col}`").cast("bigint")
    words = written(directory(docs.select(key.alias("k"), number.alias("id"))), "op13-directory")
    carry = carry or {}
    rows = docs.select(key.alias("k"), number.alias("id"), digest(*(F.col(f"`{c}`") for c in fields)).alias("leaf"), *(v.alias(f"c_{n}") for n, v in carry.items()))
    placed = coordinates(rows, words)
    groups, subroots = _reduced(placed.withColumnRenamed("leaf", "digest"))
    subroots = written(subroots, "op13-subroots")
    many = subroots.count()
    # groups are numbered as leaves are: by range, no window over all
    ranged = written(subroots.repartitionByRange("k").withColumn("part", F.spark_partition_id()), "op13-groups")
    sizes = ranged.groupBy("part").agg(F.count("*").alias("size"))
    offset = sizes.select("part", F.coalesce(F.sum("size").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("offset"))
    numbered = ranged.withColumn("nth", F.row_number().over(Window.partitionBy("part").orderBy("k"))).join(offset, "part")
    nodes = numbered.select(F.lit("").alias("k"), (F.col("nth") + F.col("offset") - 1).cast("bigint").alias("at"), F.lit(many).cast("bigint").alias("total"), "digest", F.col("k").alias("tree"))
    table, root = _reduced(nodes)
    top = _paths(table, root.select("k", F.expr("cast(array() as array<string>)").alias("path"), F.col("digest").alias("root")))
    top = top.select(F.col("slot.tree").alias("k"), "path", F.col("slot.digest").alias("subroot"), "root")
    leaves = _paths(groups, top)
    return leaves.select(F.col("slot.id").alias("id"), F.col("slot.digest").alias("leaf"), "path", "subroot", "root", *(F.col(f"slot.c_{n}").alias(n) for n in carry))


#: The fields of a document's leaf, in order.
DOCUMENT_FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def audited(docs: DataFrame) -> DataFrame:
    """The manifest of ``documents`` with a tamper audit: n_chars grows by one where 7 divides the CRC-32 of the id, and every leaf is
    folded up its original path again."""
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    grown = F.col("n_chars").cast("decimal(20,0)") + 1
    other = digest(*(grown if c == "n_chars" else F.col(c) for c in DOCUMENT_FIELDS))
    rows = manifest(docs.select(*DOCUMENT_FIELDS), "doc_id", "lang", DOCUMENT_FIELDS, {"tampered": F.when(hit, other)})
    folded = fold(F.coalesce("tampered", "leaf"), F.col("path"))
    out = rows.select(F.col("id").alias("doc_id"), "leaf", "subroot", "root", path_digest(F.col("path")).alias("proof_sha256"), folded.alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


_FIELDS_SQL = " || ".join(f"coalesce(octet_length(encode({c}::VARCHAR)) || ':' || {c}::VARCHAR, '-')" for c in ("doc_id", "source", "lang", "{n}", "text"))
#: DuckDB SQL for ``audited``: levels by recursion, the audit by walking every path.
ORACLE = f"""
WITH RECURSIVE crc(id, c) AS (
  SELECT doc_id, xor(4294967295, list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(doc_id::VARCHAR, ''), lambda ch: ascii(ch)::BIGINT)),
    lambda acc, b: list_reduce(list_concat([xor(acc, b)], [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda x, y: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384 ELSE 0 END))))
  FROM (SELECT DISTINCT doc_id FROM documents WHERE doc_id IS NOT NULL)),
leaves AS (
  SELECT d.doc_id, coalesce('=' || lang, '') AS k, sha256({_FIELDS_SQL.format(n='n_chars')}) AS leaf,
    CASE WHEN c % 7 = 0 AND n_chars IS NOT NULL THEN sha256({_FIELDS_SQL.format(n='(n_chars::HUGEINT + 1)')}) END AS tampered
  FROM documents d LEFT JOIN crc ON d.doc_id = crc.id),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY k ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY k) AS n FROM leaves),
nodes(k, level, i, n, h) AS (
  SELECT k, 0, i, n, leaf FROM placed
  UNION ALL
  SELECT k, level + 1, i // 2, (n + 1) // 2, sha256(h || coalesce(nxt, ''))
  FROM (SELECT *, lead(h) OVER (PARTITION BY k ORDER BY i) AS nxt FROM nodes) WHERE n > 1 AND i % 2 = 0),
subroots AS (SELECT k, h, row_number() OVER (ORDER BY k) - 1 AS i, count(*) OVER () AS n FROM nodes WHERE n = 1),
tops(level, i, n, h) AS (
  SELECT 0, i, n, h FROM subroots
  UNION ALL
  SELECT level + 1, i // 2, (n + 1) // 2, sha256(h || coalesce(nxt, ''))
  FROM (SELECT *, lead(h) OVER (ORDER BY i) AS nxt FROM tops) WHERE n > 1 AND i % 2 = 0),
every AS (
  SELECT k, level, i, n, h FROM nodes WHERE n > 1
  UNION ALL
  SELECT s.k, 1000 + t.level, t.i, t.n, t.h FROM subroots s, tops t WHERE t.n > 1),
sides AS (
  SELECT p.doc_id, p.k, p.i AS place, e.level, CASE WHEN e.i % 2 = 0 THEN coalesce(b.h, '') ELSE b.h END AS h, e.i % 2 = 1 AS is_left
  FROM placed p JOIN subroots s ON p.k = s.k
  JOIN every e ON e.k = p.k AND e.i = CASE WHEN e.level < 1000 THEN p.i >> e.level ELSE s.i >> (e.level - 1000) END
  LEFT JOIN every b ON b.k = e.k AND b.level = e.level AND b.i = xor(e.i, 1)),
proofs AS (
  SELECT k, place, string_agg(h, '' ORDER BY level) AS proof, list(struct_pack(h := h, l := is_left) ORDER BY level) AS path FROM sides GROUP BY k, place),
folds(k, place, path, h) AS (
  SELECT p.k, p.i, coalesce(path, []), coalesce(tampered, leaf) FROM placed p LEFT JOIN proofs q ON p.k = q.k AND p.i = q.place
  UNION ALL
  SELECT k, place, path[2:], CASE WHEN path[1].l THEN sha256(path[1].h || h) ELSE sha256(h || path[1].h) END FROM folds WHERE len(path) > 0)
SELECT p.doc_id, p.leaf, s.h AS subroot, t.h AS root, sha256(coalesce(q.proof, '')) AS proof_sha256, f.h AS folded_root, f.h = t.h AS verified
FROM placed p JOIN subroots s ON p.k = s.k JOIN tops t ON t.n = 1 LEFT JOIN proofs q ON p.k = q.k AND p.i = q.place
JOIN folds f ON f.k = p.k AND f.place = p.i AND len(f.path) = 0
"""
