"""Near-duplicate documents by an LSH forest over MinHash signatures (numbered operator 4).

A document's set is its distinct 5-word shingles (with fewer words, the whole word sequence as one). Documents link if
their sets have a Jaccard similarity of ``percent``/100 or more.

1. Documents with equal sets form a class (a 128-bit hash of the sorted set), so exact copies cost one signature and no pairs.
2. Each class has a signature of TREES x DEPTH minimum hashes (16 bits kept of each). Tree t sorts the classes by its DEPTH
   values. Classes with equal first MIN_DEPTH values form a region; inside it the neighbours in the sorted order have the
   longest common prefix, so the depth at which two classes meet adapts to how crowded the region is. Each class is paired
   with its neighbour, with the first of its stretch of the region, and in regions of CROWD classes or more with the region's hub
   (edited copies of one text are closer to that text than to each other): a number of pairs linear in the region, however large.
3. Pairs whose signatures allow the similarity are confirmed on the full sets, and components are taken.
4. The rest: in a region that still holds several components, all pairs between different components are compared by signature, block
   against block (a class meets every block of its region, a task step holds two blocks), each pair in the first tree that has
   it. Classes with a candidate are compared again with their full sets at hand, in blocks bounded in bytes, and a step emits
   links only where they join two components: fewer than the classes it holds, however many pairs are similar.

Two classes at the threshold miss each other in every tree with a chance of (1 - s^MIN_DEPTH)^TREES (5e-10 at s = 0.85, 2e-7 at
s = 0.8), whatever the size of their regions; the signature test of step 4 lets all pairs through but those 7 standard errors below the threshold (1e-10
of the pairs at it).

Defined results: null, empty and wordless texts have an empty set and link with nothing; rows with a null id take part, and a
component of null ids alone has a null component id; repeated rows fall into one class; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candela.llm import bitmap
from candela.llm import textkit as K
from candela.llm.graph import Forest, components
from candela.llm.stages import written

SHINGLE = 5
PERCENT = 85
TREES, DEPTH, MIN_DEPTH = 29, 5, 4
#: A block has up to so many classes, and bytes of sets.
BLOCK, BLOCK_BYTES = 512, 8 << 20
CROWD = 16
WIDTH = TREES * DEPTH

_RNG = np.random.default_rng(7)
_XOR = _RNG.integers(0, 2**32, WIDTH, dtype=np.uint32)
_ODD = _RNG.integers(0, 2**31, WIDTH, dtype=np.uint32) * np.uint32(2) + np.uint32(1)


def shingle_sets(column, k: int = SHINGLE) -> list[np.ndarray]:
    """The sorted distinct 64-bit shingle hashes of each text."""
    w = K.words(column, K.SPACE_WORD, lower=True)
    g, _ = w.grams(k)
    out = []
    for i in range(w.n_rows):
        lo, hi = int(w.first[i]), int(w.first[i + 1])
        if hi - lo >= k:
            out.append(np.unique(g[lo:hi - k + 1]))
        elif hi > lo:
            whole, _ = K.grams(w.hash[lo:hi], np.array([0, hi - lo]), hi - lo)
            out.append(whole[:1])
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """(documents, WIDTH) low 16 bits of the minimum hashes; rows of empty sets are zero."""
    out = np.zeros((len(sets), WIDTH), dtype=np.uint16)
    full = [i for i, s in enumerate(sets) if len(s)]
    if full:
        x = (np.concatenate([sets[i] for i in full]) >> np.uint64(32)).astype(np.uint32)
        at = np.concatenate(([0], np.cumsum([len(sets[i]) for i in full])[:-1]))
        v = np.empty_like(x)
        for k in range(WIDTH):
            np.bitwise_xor(x, _XOR[k], out=v)
            np.multiply(v, _ODD[k], out=v)
            out[full, k] = np.minimum.reduceat(v, at).astype(np.uint16)
    return out


def _class_key(s: np.ndarray) -> bytes | None:
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None


def _signed(docs: DataFrame, id_col: str, text: str) -> DataFrame:
    """id, text hash, class key (null for an empty set), set size, signature and its low bytes (sketch) of every row."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(K.text_column(docs, text)).alias("th"), K.text_column(docs, text).alias("text"))

    def run(batches):
        for batch in batches:
            for part in K.chunks(batch, "text"):
                sets = shingle_sets(part.column("text"))
                sig = signatures(sets)
                key = [_class_key(s) for s in sets]
                low = sig.astype(np.uint8)
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), part.column("th"), pa.array(key, pa.binary()), pa.array([len(s) for s in sets], pa.int64()),
                     pa.array([r.tobytes() if k else None for k, r in zip(key, sig)], pa.binary()),
                     pa.array([r.tobytes() if k else None for k, r in zip(key, low)], pa.binary())], names=["id", "th", "cls", "n", "sig", "sketch"])
    return rows.mapInArrow(K.handing_back(run), "id bigint, th bigint, cls binary, n bigint, sig binary, sketch binary")


def _leaves(classes: DataFrame) -> DataFrame:
    """Each class once per tree, with its path and region, where the region has another class."""
    tree = F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))).alias("tree")
    at = F.col("tree") * (2 * DEPTH) + 1
    region = F.xxhash64("tree", F.substring("sig", at, F.lit(2 * MIN_DEPTH)))
    slim = classes.select("cls", "sig", tree).select("cls", "tree", region.alias("region"))
    shared = slim.groupBy("region").agg(F.count("*").alias("size")).filter("size > 1")
    path = F.substring("sig", at, F.lit(2 * DEPTH))
    return slim.join(shared, "region").join(classes, "cls").select(
        "region", "tree", F.xxhash64("tree", path).alias("deep"), path.alias("path"), "cls", "n", "sketch", "size")


def _rows_of(column, width: int) -> np.ndarray:
    """A binary column of equal lengths as a matrix of bytes."""
    data = np.frombuffer(column.buffers()[2], np.uint8) if len(column) else np.zeros(0, np.uint8)
    return data[column.offset * width:(column.offset + len(column)) * width].reshape(len(column), width)


def _similar(sketch: np.ndarray, n: np.ndarray, x: np.ndarray, y: np.ndarray, percent: int, errors: int = 5) -> np.ndarray:
    """Whether set sizes and signatures of rows x and y allow the similarity, to ``errors`` standard errors."""
    s = percent / 100
    least = WIDTH * (s - errors * np.sqrt(s * (1 - s) / WIDTH))
    ok = 100 * np.minimum(n[x], n[y]) >= percent * np.maximum(n[x], n[y])
    at = np.flatnonzero(ok)
    for lo in range(0, len(at), 1 << 15):
        i = at[lo:lo + (1 << 15)]
        ok[i] = (sketch[x[i]] == sketch[y[i]]).sum(axis=1) >= least
    return ok


_PAIR = "a binary, b binary"


def _pairs(cls, x: np.ndarray, y: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([cls.take(pa.array(x)), cls.take(pa.array(y))], names=["a", "b"])


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _pairs_with_hub(leaves: DataFrame, percent: int) -> DataFrame:
    """Pairs of each class of a crowded region with the region's hub: the class that agrees with most of the frequent signature
    values around it. Stretches of the region propose their best, the region takes the best of these."""
    crowd = leaves.filter(F.col("size") >= CROWD).select("region", "path", "cls", "n", "sketch")

    def propose(batches):
        for batch in batches:
            region, sketch = batch.column("region").to_numpy(), _rows_of(batch.column("sketch"), WIDTH)
            cut = np.flatnonzero(np.concatenate(([True], region[1:] != region[:-1], [True]))) if len(region) else np.zeros(1, int)
            best, score = [], []
            for lo, hi in zip(cut[:-1], cut[1:]):
                if 2 * (hi - lo) >= CROWD or hi - lo == len(region):
                    block = sketch[lo:hi].astype(np.int64) + 256 * np.arange(WIDTH)
                    mode = np.bincount(block.ravel(), minlength=256 * WIDTH).reshape(WIDTH, 256).argmax(axis=1)
                    agree = (sketch[lo:hi] == mode).sum(axis=1)
                    best.append(lo + int(agree.argmax()))
                    # a short stretch agrees with itself by chance
                    score.append(int(agree.max()) * min(int(hi - lo), CROWD))
            take = batch.select(["region", "cls", "n", "sketch"]).take(pa.array(best, pa.int64()))
            yield pa.RecordBatch.from_arrays([*take.columns, pa.array(score, pa.int64())], names=["region", "hub", "hub_n", "hub_sketch", "score"])

    order = crowd.repartitionByRange("region", "path").sortWithinPartitions("region", "path")
    proposed = order.mapInArrow(K.handing_back(propose), "region bigint, hub binary, hub_n bigint, hub_sketch binary, score bigint")
    hubs = proposed.groupBy("region").agg(F.max(F.struct("score", "hub", "hub_n", "hub_sketch")).alias("h")).select("region", "h.hub", "h.hub_n", "h.hub_sketch")

    def compare(batches):
        for batch in batches:
            both = np.concatenate((_rows_of(batch.column("sketch"), WIDTH), _rows_of(batch.column("hub_sketch"), WIDTH)))
            n = np.concatenate((batch.column("n").to_numpy(), batch.column("hub_n").to_numpy()))
            x = np.arange(batch.num_rows)
            ok = pa.array(_similar(both, n, x, x + batch.num_rows, percent))
            yield pa.RecordBatch.from_arrays([batch.column("cls").filter(ok), batch.column("hub").filter(ok)], names=["a", "b"])
    met = crowd.join(hubs, "region").filter("cls <> hub").select("cls", "n", "sketch", "hub", "hub_n", "hub_sketch")
    return met.mapInArrow(K.handing_back(compare), _PAIR)


def _neighbours(leaves: DataFrame, percent: int) -> DataFrame:
    """Pairs of neighbours in the regions' sorted orders, and of each class with its region's hub. Range partitions may cut a region
    between two neighbours; step 4 sees it whole."""
    def run(batches):
        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            both = batch if last is None else pa.Table.from_batches([last, batch]).combine_chunks().to_batches()[0]
            region, sketch = both.column("region").to_numpy(), _rows_of(both.column("sketch"), WIDTH)
            new = np.concatenate(([True], region[1:] != region[:-1]))
            y = np.flatnonzero(~new)
            head = np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))
            x, y = np.concatenate((y - 1, head[y])), np.concatenate((y, y))
            ok = _similar(sketch, both.column("n").to_numpy(), x, y, percent)
            yield _pairs(both.column("cls"), x[ok], y[ok])
            last = batch.slice(batch.num_rows - 1)
    order = leaves.select("region", "path", "cls", "n", "sketch").repartitionByRange("region", "path").sortWithinPartitions("region", "path", "cls")
    return _ordered(order.mapInArrow(K.handing_back(run), _PAIR).union(_pairs_with_hub(leaves, percent)))


def _whole_groups(batches):
    """The rows of sorted batches again, cut only between values of column ``g``."""
    rest = None
    for batch in batches:
        if not batch.num_rows:
            continue
        both = batch if rest is None else pa.Table.from_batches([rest, batch]).combine_chunks().to_batches()[0]
        g = both.column("g").to_numpy()
        cut = int(np.flatnonzero(g == g[-1])[0])
        if cut:
            yield both.slice(0, cut)
        rest = both.slice(cut)
    if rest is not None:
        yield rest


def _mixed(leaves: DataFrame, classes: DataFrame, labels: DataFrame) -> DataFrame:
    """The classes of regions with several components: region, tree, cls, label (of the component), n and sig."""
    tagged = leaves.select("region", "tree", "cls").join(labels, F.col("cls") == F.col("node"), "left").select("region", "tree", "cls", F.xxhash64(F.coalesce("label", "cls")).alias("label"))
    mixed = tagged.groupBy("region").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).filter("lo <> hi").select("region")
    return tagged.join(mixed, "region").join(classes.select("cls", "n", "sig"), "cls")


def _in_blocks(member: DataFrame, size) -> DataFrame:
    """``member`` dealt into blocks by a hash of the class: a row goes to every pair of blocks (g) that holds its own. ``size``: a region's number of blocks."""
    counts = member.groupBy("region").agg(F.greatest(F.ceil(size), F.ceil(F.count("*") / BLOCK)).alias("blocks"))
    dealt = member.join(counts, "region").withColumn("own", F.pmod(F.xxhash64("cls"), F.col("blocks"))).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    dealt = dealt.withColumn("g", F.xxhash64("region", F.least("own", "other"), F.greatest("own", "other"))).withColumn("same", F.col("own") == F.col("other"))
    return dealt.drop("blocks", "other").repartition("g").sortWithinPartitions("g")


def _candidates(rows: pa.RecordBatch, percent: int):
    """Row pairs (x, y) in whole groups: of different components, similar by signature, and in no region of an earlier tree together."""
    g, own, tree, label, n = (rows.column(c).to_numpy() for c in ("g", "own", "tree", "label", "n"))
    same = rows.column("same").to_numpy(zero_copy_only=False)
    sig = _rows_of(rows.column("sig"), 2 * WIDTH).view("<u2")
    sketch, paths = sig.astype(np.uint8), sig.reshape(len(sig), TREES, DEPTH)[:, :, :MIN_DEPTH]
    for step in range(1, len(g)):
        x = np.flatnonzero(g[step:] == g[:-step])
        if not len(x):
            return  # groups are contiguous: no longer distance has a pair either
        y = x + step
        ok = (label[x] != label[y]) & ((own[x] != own[y]) | same[x])
        x, y = x[ok], y[ok]
        ok = _similar(sketch, n, x, y, percent, errors=7)
        x, y = x[ok], y[ok]
        if len(x):
            before = (paths[x] == paths[y]).all(axis=2) & (np.arange(TREES) < tree[x][:, None])
            new = ~before.any(axis=1)
            yield x[new], y[new]


def _linked(sets: list[np.ndarray], x: np.ndarray, y: np.ndarray, percent: int) -> np.ndarray:
    """Whether the full sets x and y meet ``percent``."""
    size = np.array([len(s) for s in sets])
    at = np.concatenate(([0], np.cumsum(size)))
    code = np.unique(np.concatenate(sets), return_inverse=True)[1]
    mark, both = np.zeros(int(code.max()) + 1, bool), np.zeros(len(x), np.int64)
    order = np.argsort(x, kind="stable")
    for part in np.split(order, np.flatnonzero(np.diff(x[order])) + 1):
        i, js = x[part[0]], y[part]
        mine = code[at[i]:at[i + 1]]
        mark[mine] = True
        both[part] = (np.add.reduceat(mark[code], at[:-1], dtype=np.int64)[js] if 8 * len(js) > len(sets)
                      else [np.count_nonzero(mark[code[at[j]:at[j + 1]]]) for j in js])
        mark[mine] = False
    return 100 * both >= percent * (size[x] + size[y] - both)


def _across(leaves: DataFrame, classes: DataFrame, labels: DataFrame, docs: DataFrame, id_col: str, text: str, percent: int) -> DataFrame:
    """Links that join different components: of all links between classes of one region, a spanning forest in each step."""
    member = written(_mixed(leaves, classes, labels), "op4-mixed")

    def flag(batches):
        for rows in _whole_groups(batches):
            hit = np.zeros(rows.num_rows, bool)
            for x, y in _candidates(rows, percent):
                hit[x] = hit[y] = True
            yield rows.select(["region", "cls"]).filter(pa.array(hit))
    near = written(_in_blocks(member, F.lit(1)).mapInArrow(K.handing_back(flag), "region bigint, cls binary").distinct(), "op4-near")
    sets = _sets(near.select("cls").distinct(), docs, classes, id_col, text)
    whole = member.join(near, ["region", "cls"]).join(sets, "cls")

    def link(batches):
        for rows in _whole_groups(batches):
            found = [np.concatenate(z) for z in zip(*_candidates(rows, percent))] or [np.zeros(0, int)] * 2
            cls, label, items = rows.column("cls"), rows.column("label").to_numpy(), rows.column("items")
            g = rows.column("g").to_numpy()
            for lo in np.flatnonzero(np.concatenate(([True], g[1:] != g[:-1]))):
                hi = int(np.searchsorted(g, g[lo], "right"))
                mine = (found[0] >= lo) & (found[0] < hi)
                if not mine.any():
                    continue
                x, y = found[0][mine] - lo, found[1][mine] - lo
                ok = _linked([np.frombuffer(items[i].as_buffer(), np.uint64) for i in range(lo, hi)], x, y, percent)
                forest = Forest(label[lo:hi])
                forest.add(x[ok], y[ok])
                for i, j in forest.links:
                    yield _pairs(cls, i + lo, j + lo)
    return _ordered(_in_blocks(whole, F.sum(8 * F.col("n")) / BLOCK_BYTES).mapInArrow(K.handing_back(link), _PAIR))


def _sets(need: DataFrame, docs: DataFrame, classes: DataFrame, id_col: str, text: str) -> DataFrame:
    """(cls, items) of the classes in ``need``: their full sets, rebuilt from the texts of their first ids."""
    reps = classes.join(need, "cls").select(F.xxhash64("rep").alias("probe"))
    asked = bitmap.build(reps, "probe")
    texts = docs.select(F.xxhash64(F.col(id_col).cast("long")).alias("probe"), K.text_column(docs, text).alias("text"))

    def sets(batches):
        for batch in batches:
            found = bitmap.holds(asked.value, batch.column("probe").to_numpy().astype(np.uint64))
            batch = batch.filter(pa.array(found))
            for part in K.chunks(batch, "text"):
                s = [x for x in shingle_sets(part.column("text")) if len(x)]
                yield pa.RecordBatch.from_arrays([pa.array([_class_key(x) for x in s], pa.binary()), pa.array([x.tobytes() for x in s], pa.binary())], names=["cls", "items"])

    table = texts.mapInArrow(K.handing_back(sets), "cls binary, items binary").join(need, "cls", "left_semi")
    return written(table.groupBy("cls").agg(F.any_value("items").alias("items")), "op4-sets")


def _confirmed(pairs: DataFrame, docs: DataFrame, classes: DataFrame, id_col: str, text: str, percent: int) -> DataFrame:
    """The pairs whose full sets meet ``percent``."""
    table = _sets(pairs.select(F.explode(F.array("a", "b")).alias("cls")).distinct(), docs, classes, id_col, text)

    @F.pandas_udf("boolean")
    def linked(x: pd.Series, y: pd.Series) -> pd.Series:
        out = []
        for p, q in zip(x, y):
            p, q = np.frombuffer(p, np.uint64), np.frombuffer(q, np.uint64)
            both = len(np.intersect1d(p, q, assume_unique=True))
            out.append(100 * both >= percent * (len(p) + len(q) - both))
        return pd.Series(out, dtype=bool)

    one = table.select(F.col("cls").alias("a"), F.col("items").alias("ia"))
    two = table.select(F.col("cls").alias("b"), F.col("items").alias("ib"))
    return pairs.join(one, "a").join(two, "b").filter(linked("ia", "ib")).select("a", "b")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """One row per row of ``docs``: id, th (hash of the text), n_shingles, component_id (smallest id reachable over links,
    itself included) and ``lead``: whether the row is its component's first by (id, th), nulls last; rows with an empty set lead themselves."""
    rows = written(_signed(docs, id_col, text), "op4-rows")
    place = F.struct(F.col("id").isNull().alias("null_id"), "id", "th")
    classes = written(rows.filter("cls is not null").groupBy("cls").agg(
        F.min(place).alias("first"), *(F.any_value(c).alias(c) for c in ("n", "sig", "sketch"))).withColumn("rep", F.col("first.id")), "op4-classes")
    leaves = written(_leaves(classes.select("cls", "n", "sig", "sketch")), "op4-leaves")

    links = written(_confirmed(written(_neighbours(leaves, percent), "op4-pairs"), docs, classes, id_col, text, percent), "op4-links")
    labels = written(components(links), "op4-labels")
    late = written(_across(leaves, classes, labels, docs, id_col, text, percent), "op4-late")
    # what is linked so far is stars by now
    labels = written(components(labels.select(F.col("node").alias("a"), F.col("label").alias("b")).union(late)), "op4-labels")

    named = classes.select("cls", "first").join(labels, F.col("cls") == F.col("node"), "left").select("cls", "first", F.coalesce("label", "cls").alias("label"))
    smallest = named.groupBy("label").agg(F.min("first").alias("top"))
    final = named.join(smallest, "label").select(F.col("cls").alias("c"), "top")
    out = rows.select("id", "th", "cls", "n").join(final, F.col("cls") == F.col("c"), "left")
    alone = F.col("cls").isNull()
    return out.select("id", "th", F.col("n").alias("n_shingles"), F.when(alone, F.col("id")).otherwise(F.col("top.id")).alias("component_id"),
                      (alone | (F.col("id").eqNullSafe(F.col("top.id")) & (F.col("th") == F.col("top.th")))).alias("lead"))


def first_of_each(docs: DataFrame, id_col: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """``docs`` with one row of each group of near-duplicates; columns as they came."""
    lead = near_duplicates(docs, id_col, text, percent).filter("lead").select(
        F.col("id").alias("__id"), F.col("th").alias("__th"), (F.col("n_shingles") == 0).alias("__empty")).distinct()
    keyed = docs.withColumn("__key", F.col(id_col).cast("long")).withColumn("__hash", F.xxhash64(K.text_column(docs, text)))
    kept = keyed.join(lead, F.col("__key").eqNullSafe(F.col("__id")) & (F.col("__hash") == F.col("__th")))
    # rows equal in id and text are one group too, except those without words
    once = kept.filter(~F.col("__empty")).dropDuplicates(["__key", "__hash"])
    return once.unionByName(kept.filter("__empty")).select(docs.columns)
