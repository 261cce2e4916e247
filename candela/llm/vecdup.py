"""Near-duplicate vectors of one label by cosine (numbered operator 12).

1. Equal vectors of a label form a class; copies cost no comparison and are counted in the end.
2. The principal axes of the unit vectors (second moments over all classes, summed by Spark) give an order of dimensions, most of
   the norm first. Classes are sorted by (label, first axis) and cut into tiles of TILE rows; a tile keeps its box over the BOX
   leading axes and the range of the norm of the rest.
3. Two tiles meet only if their boxes are near enough for the threshold: a cosine of t means a distance of sqrt(2 - 2 t) of unit
   vectors. Tile pairs come from an equi-join on the strip of the first axis and are tested on the whole box, before any vector moves.
4. In a tile pair, inner products are accumulated over the leading axes first, CUTS at a time; the rest of the product is at most the product
   of the suffix norms, and a pair of rows stops when that cannot reach the threshold. What is left is decided by the cosine of the
   vectors as they came, in double precision.
5. A tile pair returns the number of links of each row and a star for each component of its links, at most as many rows as it holds,
   so a crowd of near copies is not expanded; components are taken over the stars. A class's name begins with its smallest id, so the
   smallest name of a component tells its id.

Defined results: rows with a null label, and vectors that are null, empty, zero or hold null or non-finite components link with nothing; so do
vectors of different lengths with each other. Repeated rows are rows: each gets a result and counts as a link of the others. Components
ignore null ids; a component of null ids alone has a null id. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candela.llm.graph import Forest, components
from candela.llm.stages import written
from candela.llm.vectors import finite, grouped, matrices, packed, unpacked

COSINE = 0.93
TILE = 2048
BOX = 6
CUTS = (8, 16, 32)
#: Rows of a tile that are compared with the other tile at once, and pairs of rows gathered at once.
STRIP, GATHER = 256, 1 << 15
#: Bounds are taken with this margin; the last test is exact.
MARGIN = 1e-9
#: Characters of a class key, two 64-bit hashes in hexadecimal, and of a class name, its smallest id and the key.
KEY = 32
NAME = 17 + KEY
_LEAST = -1 << 63


def _keyed(rows: DataFrame, id_col: str, vec: str, label: str) -> DataFrame:
    v, g = F.col(f"`{vec}`"), F.col(f"`{label}`")
    ok = g.isNotNull() & finite(v) & F.coalesce(F.exists(v, lambda x: x != 0), F.lit(False))
    half = lambda *c: F.lpad(F.hex(F.xxhash64(*c)), KEY // 2, "0")
    key = F.concat(half(g, v), half(F.lit(12), v, g))
    return rows.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), F.when(ok, key).alias("cls"), g.alias("label"), v.alias("vec"))


def _name(first, key):
    """A class name: in the order of the smallest ids, no id last."""
    digits = F.lpad(F.hex(first.bitwiseXOR(F.lit(_LEAST))), 16, "0")
    return F.concat(F.when(first.isNull(), F.lit("1" + "0" * 16)).otherwise(F.concat(F.lit("0"), digits)), key)


def _named_id(name):
    """The smallest id in a class name."""
    digits = F.conv(F.substring(name, 2, 16), 16, -10).cast("bigint")
    return F.when(F.substring(name, 1, 1) == "0", digits.bitwiseXOR(F.lit(_LEAST)))


def scaled(x: np.ndarray) -> np.ndarray:
    """Rows divided by a power of two, so that squares neither overflow nor vanish; cosines stay the same to the last digit."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, initial=0.0))[1][:, None])


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt((x * x).sum(axis=1))[:, None]


def principal_axes(classes: DataFrame) -> dict[int, np.ndarray]:
    """The axes (columns, most of the norm first) of the most frequent vector length; vectors of another length keep their own order."""
    size = classes.groupBy(F.size("vec").alias("d")).count().orderBy(F.desc("count"), "d").first()
    if size is None:
        return {}
    d = size["d"]

    def moments(batches):
        total = np.zeros((d, d))
        for batch in batches:
            for _, x in matrices(batch.column(0)):
                u = _unit(scaled(x))
                total += u.T @ u
        i, j = np.triu_indices(d)
        yield pa.RecordBatch.from_arrays([pa.array(i * d + j), pa.array(total[i, j])], names=["at", "v"])
    summed = classes.filter(F.size("vec") == d).select("vec").mapInArrow(moments, "at bigint, v double").groupBy("at").agg(F.sum("v").alias("v"))
    full = np.zeros(d * d)
    for r in summed.toLocalIterator():
        full[r["at"]] = r["v"]
    full = full.reshape(d, d)
    _, axes = np.linalg.eigh(full + np.triu(full, 1).T)
    return {d: np.ascontiguousarray(axes[:, ::-1])}


def _turned(x: np.ndarray, axes: dict) -> np.ndarray:
    u = _unit(x)
    return u @ axes[x.shape[1]] if x.shape[1] in axes else u


def _tiles(classes: DataFrame, axes) -> DataFrame:
    """Tiles of classes next to each other on the first axis: key, label, length, box (lo, hi), class keys, copies and vectors, packed."""
    def place(batches):
        for batch in batches:
            for at, x in matrices(batch.column("vec")):
                x = scaled(x)
                part = batch.take(pa.array(at))
                yield pa.RecordBatch.from_arrays([part.column("label"), pa.array(np.full(len(at), x.shape[1], np.int32)), pa.array(_turned(x, axes.value)[:, 0]),
                                                  part.column("cls"), part.column("n"), pa.array(packed(x), pa.binary())], names=["label", "d", "lead", "cls", "n", "x"])

    def cut(batches):
        made = TaskContext.get().partitionId() << 32
        for (label, d), part in grouped(batches, ["label", "d"], TILE):
            x = np.frombuffer(b"".join(part.column("x").to_pylist()), np.float64).reshape(-1, d)
            t = _turned(x, axes.value)
            box = np.column_stack((t[:, :BOX], np.sqrt((t[:, BOX:] ** 2).sum(axis=1))))
            yield pa.RecordBatch.from_pylist([{"tile": made, "label": label, "d": d, "lo": box.min(axis=0).tolist(), "hi": box.max(axis=0).tolist(),
                                               "cls": "".join(part.column("cls").to_pylist()).encode(), "n": part.column("n").to_numpy().astype("<i8").tobytes(), "x": x.tobytes()}], schema=schema)
            made += 1
    label_type = classes.schema["label"].dataType.simpleString()
    placed = classes.select("label", "cls", "n", "vec").mapInArrow(place, f"label {label_type}, d int, lead double, cls string, n bigint, x binary")
    order = placed.repartitionByRange("label", "d", "lead", "cls").sortWithinPartitions("label", "d", "lead", "cls")
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string as parsed
    kind = f"tile bigint, label {label_type}, d int, lo array<double>, hi array<double>, cls binary, n binary, x binary"
    schema = to_arrow_schema(parsed(kind))
    return order.mapInArrow(cut, kind)


def _tile_pairs(tiles: DataFrame, cosine: float) -> DataFrame:
    """Pairs (a <= b) of tiles whose boxes are within the distance that the cosine allows."""
    reach = float(np.sqrt(max(2 - 2 * cosine, 0)) + MARGIN)
    strip = lambda v: F.floor(v / F.lit(reach or 1.0)).cast("bigint")
    lo, hi = F.element_at("lo", 1), F.element_at("hi", 1)
    meta = tiles.select("tile", "label", "d", "lo", "hi")
    one = meta.select(F.col("tile").alias("a"), "label", "d", F.col("lo").alias("alo"), F.col("hi").alias("ahi"), F.explode(F.sequence(strip(lo), strip(hi))).alias("strip"))
    two = meta.select(F.col("tile").alias("b"), "label", "d", F.col("lo").alias("blo"), F.col("hi").alias("bhi"), F.explode(F.sequence(strip(lo - reach), strip(hi + reach))).alias("strip"))
    gap = F.expr("aggregate(transform(sequence(0, size(alo) - 1), i -> pow(greatest(alo[i] - bhi[i], blo[i] - ahi[i], 0D), 2)), 0D, (x, y) -> x + y)")
    return one.join(two, ["label", "d", "strip"]).filter((F.col("a") <= F.col("b")) & (gap <= reach * reach)).select("a", "b").distinct()


def _close(x, y, tx, ty, cosine: float, lo: int, strip: int = STRIP, gather: int = GATHER):
    """Row pairs (i in x from lo, ``strip`` rows; j in y) whose cosine reaches the threshold."""
    d = x.shape[1]
    cuts = [0, *(c for c in CUTS if c < d), d]
    rows = slice(lo, lo + strip)
    a, pairs = tx[rows], None
    part = np.zeros((len(a), len(y)))
    for c, e in zip(cuts[:-1], cuts[1:]):
        rest = [np.sqrt((t[:, e:] ** 2).sum(axis=1)) for t in (a, ty)]
        if pairs is None:
            part += a[:, c:e] @ ty[:, c:e].T
            alive = part + np.outer(*rest) >= cosine - MARGIN
            if alive.mean() < 0.1:   # few are left: go on with these alone
                pairs = np.nonzero(alive)
                part = part[pairs]
        else:
            i, j = pairs
            for k in range(0, len(i), gather):
                g = slice(k, k + gather)
                part[g] += np.einsum("ij,ij->i", a[i[g], c:e], ty[j[g], c:e])
            go = part + rest[0][i] * rest[1][j] >= cosine - MARGIN
            pairs, part = (i[go], j[go]), part[go]
    i, j = pairs if pairs is not None else np.nonzero(alive)
    i = i + lo
    keep = np.zeros(len(i), bool)
    nx, ny = (np.sqrt((v * v).sum(axis=1)) for v in (x[rows], y))
    for k in range(0, len(i), gather):
        g = slice(k, k + gather)
        keep[g] = np.einsum("ij,ij->i", x[i[g]], y[j[g]]) / (nx[i[g] - lo] * ny[j[g]]) >= cosine
    return i[keep], j[keep]


def _compared(pairs: DataFrame, tiles: DataFrame, axes, cosine: float) -> DataFrame:
    """(cls, other, links): with other, a ray of a component's star; without, how many rows of the other tile a class is linked with."""
    strip, gather = STRIP, GATHER
    side = lambda s: tiles.select(F.col("tile").alias(s), *(["d"] if s == "a" else []), *(F.col(c).alias(s + c) for c in ("cls", "n", "x")))
    both = pairs.join(side("a"), "a").join(side("b"), "b")

    def run(batches):
        for batch in batches:
            for r in range(batch.num_rows):
                d, same = batch.column("d")[r].as_py(), batch.column("a")[r].as_py() == batch.column("b")[r].as_py()
                x, y = (unpacked(batch.column(c)[r], d) for c in ("ax", "bx"))
                key = np.concatenate([unpacked(batch.column(c)[r], 1, f"S{NAME}")[:, 0] for c in ("acls", "bcls")])
                nx, ny = (unpacked(batch.column(c)[r], 1, "<i8")[:, 0] for c in ("an", "bn"))
                tx, ty = _turned(x, axes.value), _turned(y, axes.value)
                forest, seen = Forest(np.arange(len(key))), np.zeros(len(key))
                shift = 0 if same else len(x)
                for lo in range(0, len(x), strip):
                    i, j = _close(x, y, tx, ty, cosine, lo, strip, gather)
                    if same:
                        i, j = i[i < j], j[i < j]
                    seen += np.bincount(i, ny[j], len(key)) + np.bincount(j + shift, nx[i], len(key))
                    forest.add(i, j + shift)
                hit = np.flatnonzero(seen)
                # of each component a star around its least key: stars of different tiles share their centres
                hit = hit[np.lexsort((key[hit], forest.lab[hit]))]
                new = np.concatenate(([True], forest.lab[hit][1:] != forest.lab[hit][:-1]))[:len(hit)]
                j = hit[np.maximum.accumulate(np.where(new, np.arange(len(hit)), 0))]
                i, j = hit[~new], j[~new]
                texts = lambda at: [k.decode() for k in key[at].tolist()]
                yield pa.RecordBatch.from_arrays([pa.array(texts(hit) + texts(i), pa.string()), pa.array([None] * len(hit) + texts(j), pa.string()),
                                                  pa.array([*seen[hit].astype(np.int64).tolist(), *([None] * len(i))], pa.int64())], names=["cls", "other", "links"])
    return both.mapInArrow(run, "cls string, other string, links bigint")


def near_vectors(rows: DataFrame, id_col: str = "vec_id", vec: str = "embedding", label: str = "label", cosine: float = COSINE) -> DataFrame:
    """One row per row of ``rows``: id, n_links (other rows of its label with a cosine of at least ``cosine``) and component_id (the
    smallest id reachable over links, its own included)."""
    spark = rows.sparkSession
    keyed = _keyed(rows, id_col, vec, label)
    classes = keyed.filter("cls is not null").groupBy("cls", "label", "vec").agg(F.count("*").alias("n"), F.min("id").alias("first"))
    classes = classes.select(_name(F.col("first"), F.col("cls")).alias("cls"), F.col("cls").alias("key"), "label", "vec", "n")
    classes = written(classes, "op12-classes")
    axes = spark.sparkContext.broadcast(principal_axes(classes))   # one matrix of the vectors' length, whatever the number of rows
    tiles = written(_tiles(classes, axes), "op12-tiles")
    found = written(_compared(_tile_pairs(tiles, cosine), tiles, axes, cosine), "op12-found")
    labels = components(found.filter("other is not null").select(F.col("cls").alias("a"), F.col("other").alias("b")))
    counts = found.filter("other is null").groupBy("cls").agg(F.sum("links").alias("links"))
    named = classes.select("cls", "key", "n").join(labels, F.col("cls") == F.col("node"), "left").join(counts, "cls", "left")
    known = named.select("key", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("links"), _named_id(F.coalesce("label", "cls")).alias("component_id"))
    alone = F.col("cls").isNull()
    return keyed.select("id", "cls").join(known, F.col("cls") == F.col("key"), "left").select(
        "id", F.coalesce("links", F.lit(0)).alias("n_links"), F.when(alone, F.col("id")).otherwise(F.col("component_id")).alias("component_id"))


#: DuckDB SQL for the query: all pairs of a label, components by recursion.
ORACLE = f"""
WITH RECURSIVE ok AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= {COSINE}),
reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
counts AS (SELECT a, count(*) AS n FROM links GROUP BY a),
lows AS (SELECT a, min(b) AS low FROM reach GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, least(vec_id, coalesce(low, vec_id)) AS component_id, vec_id = least(vec_id, coalesce(low, vec_id)) AS kept
FROM embeddings LEFT JOIN counts c ON vec_id = c.a LEFT JOIN lows l ON vec_id = l.a
"""
