"""Near-duplicate lines by a deletion-neighbourhood join (numbered operator 7), in DataFrame functions only.

A line is its sequence of words (runs without white space). Lines with a word are compared, whatever their length.
A line goes if an earlier one, in the order (doc_id, text hash, line number), nulls last, has the same words, or, for
lines of NEAR_WORDS or more, is within an edit distance of one word (a word changed, added or left out).

1. Equal lines meet by a 128-bit hash; each distinct line is represented by its first place.
2. A necessary test thins the rest: lines one edit apart share their first or their last half (by the shorter
   one's count). Distinct lines that share no half with another of a fitting count are out: first by a bitmap of fixed size in a small table,
   then exactly. Only then are the others' words read again, from the documents in which they come first.
3. The others emit their deletion variants as hashed keys: each with one word outside the shared half left out (marked with its place, for
   changed words, and unmarked, for words left out), and the whole line, to meet the unmarked variants of longer lines. A sequence's hash is the
   exclusive or of the hashes of its words with their places, so all variants of a line come from one running sum, in time linear in
   the line. Lines that meet under a key are one edit apart, so each needs only the key's first line: one aggregate per key, and one join of
   the variants whose key has lines that meet, linear in the variants, however many lines share a key.
4. The edit distance of each line to the first one it met is verified on the words.

Defined results: null texts stay null, empty ones empty; rows equal in id and text are one document and get the same result; white space
between words does not matter for comparing, and kept lines keep theirs; an empty table gives an empty result; other columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candela.llm.stages import written

MIN_WORDS = 1
NEAR_WORDS = 10
BITS = 24


#: White space inside a line, besides the single space between words.
_SPACE = "\t\x0b\f\r"


def _even(text: Column) -> Column:
    """``text`` with one space between the words of a line: its lines, trimmed, are equal strings if their words are equal."""
    uneven = F.contains(text, F.lit("  "))
    for x in _SPACE:
        uneven = uneven | F.contains(text, F.lit(x))
    return F.when(uneven, F.regexp_replace(text, "[ \\t\\x0b\\f\\r]+", " ")).otherwise(text)


def _size(line: Column) -> Column:
    """Number of words of an even line (1 for an empty one)."""
    return F.octet_length(line) - F.octet_length(F.replace(line, F.lit(" "), F.lit(""))) + 1


def _once(value: Column) -> Column:
    """``value`` computed once per row: a generator's output is not copied into the expressions that use it."""
    return F.explode(F.array(value))


def _rows(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Id, hash and text of each document."""
    rows = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    return rows.select("id", F.xxhash64("text").alias("th"), "text")


def _lines(rows: DataFrame) -> DataFrame:
    """The place, even words and hashes of each line with a word."""
    lines = rows.select("id", "th", F.posexplode(F.split(_even(F.col("text")), "\n")).alias("line_no", "line"))
    lines = lines.select("id", "th", "line_no", F.trim("line").alias("line")).filter(F.col("line") != "")
    place = F.struct(F.col("id").isNull().alias("null_id"), "id", "th", "line_no").alias("place")
    return lines.select(place, "line", F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), "line").alias("h2"))


def _first(line: str, words: Column) -> Column:
    """The first words of an even line, or the last ones for a number below 0."""
    return F.call_function("substring_index", F.col(line), F.lit(" "), words)


def _half_keys() -> Column:
    """Hashes of the first and last half, for the shorter line of a pair having as many words, or one less."""
    keys = []
    for short in (F.col("n"), F.col("n") - 1):
        half = F.shiftright(short, 1)
        keys += [F.xxhash64(short, F.lit(0), _first("line", half)), F.xxhash64(short, F.lit(1), _first("line", -half))]
    return F.when(F.col("n") >= NEAR_WORDS, F.array(*keys)).otherwise(F.array().cast("array<bigint>"))


#: Words whose running sums are kept in one array before arrays are joined: longer lines take time in proportion to their length.
STRETCH = 32
_STRETCHES = (f"transform(sequence(0, (size(sums) - 1) div {STRETCH}), b -> aggregate(slice(sums, b * {STRETCH} + 1, {STRETCH}), array(0L), "
              "(done, x) -> array_append(done, element_at(done, -1) ^ x)))")
_BEFORE_STRETCH = "slice(aggregate(parts, array(0L), (done, part) -> array_append(done, element_at(done, -1) ^ element_at(part, -1))), 1, size(parts))"
#: For each word the exclusive or of ``here`` and ``before`` of all earlier words: a line without the word then hashes to this, the sum
#: of ``before`` over the line and the word's own ``before``, exclusively or-ed.
_RUNNING = (f"transform(transform(array(zip_with(here, before, (x, y) -> x ^ y)), sums -> {_STRETCHES}), "
            f"parts -> flatten(zip_with(parts, {_BEFORE_STRETCH}, (part, sum) -> transform(slice(part, 1, size(part) - 1), x -> x ^ sum))))[0]")


def _at_places(words: str, earlier: int) -> Column:
    """Hashes of the words with their places, or with the places ``earlier`` by so many."""
    return F.transform(words, lambda x, i: F.xxhash64(i - earlier, x))


def _pieces(hashes: DataFrame, column: str) -> DataFrame:
    """A bitmap of 2^BITS bits of the hashes' top bits, as at most 2^(BITS - 6) rows; broadcast as it is, once for all joins of a plan."""
    a = hashes.select(F.shiftrightunsigned(column, 64 - BITS).alias("a"))
    return a.select(F.shiftright("a", 6).alias("piece"), F.expr("shiftleft(1L, cast(a & 63 as int))").alias("bit")).groupBy("piece").agg(F.bit_or("bit").alias("bits"))


def _probed(rows: DataFrame, value: Column, pieces: DataFrame, flag: str) -> DataFrame:
    """``rows`` with ``flag``: whether the bitmap has the hash."""
    at = rows.withColumn("__a", F.shiftrightunsigned(value, 64 - BITS))
    met = at.join(F.broadcast(pieces), F.shiftright("__a", 6) == F.col("piece"), "left")
    return met.withColumn(flag, F.expr("coalesce(bits & shiftleft(1L, cast(__a & 63 as int)), 0L) <> 0L")).drop("__a", "piece", "bits")


def _shared(firsts: DataFrame) -> DataFrame:
    """(half, changed, added) of the halves by which two lines can be one edit apart: ``changed`` if two lines have it at their own number
    of words, ``added`` if one has it at its own number and one at one word less."""
    keys = firsts.select(F.posexplode("halves").alias("k", "half"))
    counts = keys.groupBy("half").agg(F.count_if(F.col("k") < 2).alias("own"), F.count_if(F.col("k") >= 2).alias("less"))
    kinds = counts.select("half", (F.col("own") > 1).alias("changed"), ((F.col("own") > 0) & (F.col("less") > 0)).alias("added"))
    return kinds.filter("changed or added")


#: Bits of ``asks``: the half k that a line shares (changed words: 1, 2, left out words: 4, 8), and that a longer line can have one word more (16).
_ASKS = "case when k < 2 then if(changed, shiftleft(1, k), 0) | if(added, 16, 0) when added then shiftleft(1, k) else 0 end"


def _variants(asked: DataFrame) -> DataFrame:
    """(role, key, rank): role 0 marked with the place left out, 1 unmarked (of the longer line), 2 the whole line (the shorter).
    Two lines that share a half differ in the rest, so only words outside the shared half are left out."""
    cut = asked.select("rank", "asks", _once(F.transform(F.split("line", " "), lambda w: F.xxhash64(w))).alias("h"))
    at = cut.select("rank", "asks", F.size("h").alias("n"), _once(_at_places("h", 0)).alias("here"), _once(_at_places("h", 1)).alias("before"))
    bounds = {}
    for role, first, short in ((0, 1, "n"), (1, 4, "n - 1")):
        half = f"shiftright({short}, 1)"
        low, high = f"if(asks & {2 * first} <> 0, 0, {half})", f"if(asks & {first} <> 0, n, n - {half})"
        bounds[role] = (f"if(asks & {3 * first} = 0, n, {low})", f"if(asks & {3 * first} = 0, 0, {high})")
    low, high = f"least({bounds[0][0]}, {bounds[1][0]})", f"greatest({bounds[0][1]}, {bounds[1][1]})"
    some = at.filter("asks & 15 <> 0").select("*", _once(F.expr(low)).alias("low"), F.expr(high).alias("high"))
    # what all variants of a line have in common, once per line
    rest = F.expr("aggregate(concat(slice(here, 1, low), slice(before, low + 1, n)), 0L, (x, y) -> x ^ y)")
    part = [F.expr(f"slice({c}, low + 1, high - low)").alias(c) for c in ("here", "before")]
    some = some.select("rank", "asks", "n", "low", _once(F.struct(rest.alias("rest"), *part)).alias("p")).select("rank", "asks", "n", "low", "p.*")
    some = some.select("rank", "asks", "n", "low", "rest", _once(F.arrays_zip(F.expr(_RUNNING).alias("run"), "before")).alias("places"))
    left_out = some.select("rank", "asks", "n", "low", "rest", F.posexplode("places").alias("j", "x"))
    left_out = left_out.select("rank", "asks", "n", (F.col("low") + F.col("j")).alias("i"), F.expr("rest ^ x.run ^ x.before").alias("v"))
    keys = F.array(F.struct(F.lit(0).alias("role"), F.xxhash64(F.lit(0), "n", "i", "v").alias("key")), F.struct(F.lit(1).alias("role"), F.xxhash64(F.lit(1), "v").alias("key")))
    within = " or ".join(f"role = {r} and i >= {low} and i < {high}" for r, (low, high) in bounds.items())
    out = left_out.select("rank", "asks", "n", "i", F.inline(keys)).filter(within).select("role", "key", "rank")
    whole = at.filter("asks & 16 <> 0").select(F.lit(2).alias("role"), F.xxhash64(F.lit(1), F.expr("aggregate(here, 0L, (x, y) -> x ^ y)")).alias("key"), "rank")
    return out.union(whole)


def _near(firsts: DataFrame, rows: DataFrame) -> DataFrame:
    """(h1, h2) of the distinct lines that have an earlier line one edit away."""
    # halves that two distinct lines share, then the lines that have one
    halves = written(_shared(firsts), "op7-halves")
    pieces = _pieces(halves, "half")
    some = firsts.filter(F.size("halves") > 0).select("h1", "h2", F.col("place.th").alias("th"), "halves")
    for k in range(4):
        some = _probed(some, F.col("halves")[k], pieces, f"in{k}")
    some = some.filter("in0 or in1 or in2 or in3").select("h1", "h2", "th", F.posexplode("halves").alias("k", "half")).join(halves, "half")
    some = some.groupBy("h1", "h2").agg(F.expr(f"bit_or({_ASKS})").alias("asks"), F.min("th").alias("th")).filter("asks <> 0")
    some = written(some, "op7-some")
    # their words, from the documents in which they come first
    holders = _probed(rows, F.col("th"), _pieces(some, "th"), "holds").filter("holds").select("id", "th", "text")
    found = _probed(_lines(holders), F.col("h1"), _pieces(some, "h1"), "known").filter("known").join(some.drop("th"), ["h1", "h2"])
    found = found.groupBy("h1", "h2", "asks").agg(F.min(F.struct("place", "line")).alias("m")).select("h1", "h2", "asks", "m.place", "m.line")
    # ranks in the order of places: a variant carries one number for its line
    asked = found.repartitionByRange("place").sortWithinPartitions("place")
    asked = written(asked.select(F.monotonically_increasing_id().alias("rank"), "line", "h1", "h2", "asks"), "op7-asked")

    # hashed once, read for the keys under which lines meet and for their lines; a marked variant meets its like, an unmarked one a whole line
    variants = written(_variants(asked), "op7-variants")
    marked, unmarked = F.when(F.col("role") != 2, F.col("rank")), F.when(F.col("role") != 1, F.col("rank"))
    first = variants.groupBy(F.col("key").alias("meets")).agg(F.min(marked).alias("cut"), F.min(unmarked).alias("whole"), F.max(marked).alias("last_cut"), F.max(unmarked).alias("last_whole"))
    first = written(first.filter("whole < last_cut or cut < last_whole").select("meets", "cut", "whole"), "op7-meets")
    met = _probed(variants, F.col("key"), _pieces(first, "meets"), "known").filter("known").join(first, F.col("key") == F.col("meets"))
    met = met.select("rank", F.when(F.col("role") == 2, F.col("cut")).otherwise(F.col("whole")).alias("earlier")).filter("earlier < rank").distinct()

    words = lambda line: F.split(line, " ")
    other = asked.select(F.col("rank").alias("earlier"), F.col("line").alias("theirs"))
    both = met.join(asked, "rank").join(other, "earlier").select("h1", "h2", words("line").alias("mine"), words("theirs").alias("theirs"))
    return both.filter(within_one_edit(F.col("mine"), F.col("theirs"))).select("h1", "h2").distinct()


def within_one_edit(a: Column, b: Column) -> Column:
    """Whether two word arrays are at most one changed, added or missing word apart."""
    short = F.when(F.size(a) <= F.size(b), a).otherwise(b)
    long = F.when(F.size(a) <= F.size(b), b).otherwise(a)
    differs = F.array_position(F.zip_with(short, F.slice(long, F.lit(1), F.size(short)), lambda x, y: x != y), True).cast("int")
    at = F.when(differs == 0, F.size(short) + 1).otherwise(differs)  # the first place that differs
    rest = F.slice(long, at + 1, F.size(long))
    changed = (F.size(a) == F.size(b)) & (F.slice(short, at + 1, F.size(short)) == rest)
    added = (F.size(long) == F.size(short) + 1) & (F.slice(short, at, F.size(short)) == rest)
    return changed | added


def dedup_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", prefix: str = "") -> DataFrame:
    """``docs`` with the lines that repeat an earlier one taken out of ``text``, and the counts ``n_lines`` and ``n_dropped`` (their names
    take ``prefix``; columns of ``docs`` with those names are replaced)."""
    n_lines, n_dropped = prefix + "n_lines", prefix + "n_dropped"
    texts = _rows(docs, doc_id, text)
    lines = _lines(texts).select("*", _once(_size(F.col("line"))).alias("n"))
    firsts = written(lines.select("*", _half_keys().alias("halves")).groupBy("h1", "h2").agg(F.min("place").alias("place"), F.any_value("halves").alias("halves")), "op7-lines")
    kept = firsts.select("h1", "h2", "place").join(_near(firsts, texts), ["h1", "h2"], "left_anti")
    by_doc = kept.groupBy(F.col("place.id").alias("__id"), F.col("place.th").alias("__th")).agg(F.collect_list("place.line_no").alias("__kept"))
    rows = docs.drop(n_lines, n_dropped).withColumn("__doc", F.col(doc_id).cast("long")).withColumn("__hash", F.xxhash64(F.col(text).cast("string")))
    out = rows.join(by_doc, F.col("__doc").eqNullSafe(F.col("__id")) & (F.col("__hash") == F.col("__th")), "left")
    whole = F.col(text).cast("string")
    # a text of which every line is kept is not split
    size = F.octet_length(whole) - F.octet_length(F.replace(whole, F.lit("\n"), F.lit(""))) + 1
    split = F.when(F.size("__kept") == size, F.array().cast("array<string>")).otherwise(F.split(whole, "\n"))
    out = out.select("*", size.alias("__size"), _once(split).alias("__every"))
    every, goes = F.col("__every"), F.col("__goes")
    compared = F.filter(F.transform(every, lambda line, i: F.when(F.ltrim(line, F.lit(" " + _SPACE)) != "", i)), lambda i: i.isNotNull())
    out = out.select("*", _once(F.array_except(compared, F.coalesce("__kept", F.array().cast("array<int>")))).alias("__goes"))
    stays = F.array_except(F.sequence(F.lit(0), F.size(every) - 1), goes)
    left = F.when(F.size(goes) == 0, whole).otherwise(F.array_join(F.transform(stays, lambda i: every[i]), "\n"))
    return (out.withColumn(n_lines, F.coalesce("__size", F.lit(0)).cast("long")).withColumn(n_dropped, F.coalesce(F.size(goes), F.lit(0)).cast("long"))
            .withColumn(text, left).select(*docs.drop(n_lines, n_dropped).columns, n_lines, n_dropped))
