"""Hard negatives by integer inner product (numbered operator 11).

Components become floor(scale * x). A row's score is its inner product with the anchor; higher scores come first, ties by smaller id. An
anchor's positives are its first ``positives`` other rows of its label; for each positive, its hard negatives are the first ``negatives``
rows of another label whose score lies between ``low`` and ``high`` percent of the positive's.

1. Blocks. Rows are sorted by (label, place on a Hilbert curve through the HILBERT_DIMS widest dimensions) and written as a Parquet
   table of blocks of up to BLOCK rows of one label, each with a zone map: least and greatest value of every dimension.
2. Bounds. For an anchor, interval arithmetic over a block's zone map bounds every score in the block. Groups of anchors meet
   pages of zone maps (no vectors). A block that lies inside a window whole, and holds enough rows, gives the least score that can still count
   (``_floors``); a block must be read if its greatest score reaches that and its interval meets a window (``_needed``).
3. Scan. Blocks go to the groups that need them, a group's blocks spread over SPREAD keys; a task holds one group and one block and
   keeps the first few of every window. What the tasks keep is merged by Spark.
The search runs twice: same label with an open window for the positives, other labels with a window for each positive.

Every anchor is a query against all rows; the bounds only leave out blocks that cannot matter, so results are exact. A group of anchors
or a block never exceeds its size, whatever share of the rows a label or a vector holds.

Defined results: rows with a null label, a null vector, or any null or non-finite component take no part, nor does a row count for
anchors with another number of components. Rows with the anchor's id are the anchor itself, not others; otherwise repeated
rows are rows, and repeated anchors each get results. Null ids come last among ties, and are no anchors. Components are held to +-sqrt(2^53 / length) so
that products are exact (9 million over 64 dimensions). A positive score below zero has an empty window. Empty vectors score 0. An
empty table, or one without anchors, gives an empty result. Labels are integers; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candela.llm.stages import written
from candela.llm.vectors import finite, grouped, matrices, packed, unpacked

BLOCK = 1024
GROUP = 256
PAGE = 512
SPREAD = 16
HILBERT_DIMS, HILBERT_BITS = 15, 4
_NO_ID = (1 << 63) - 1


def quantised(x: np.ndarray, scale: float) -> np.ndarray:
    most = np.floor(np.sqrt(2.0**53 / max(x.shape[1], 1)))
    with np.errstate(over="ignore"):
        return np.clip(np.floor(x * scale), -min(most, 2.0**31 - 1), min(most, 2.0**31 - 1))


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of points with integer coordinates below 2^bits (Skilling's transform, all rows at once)."""
    x = cells.astype(np.int64).T.copy()
    n = len(x)
    for q in (1 << b for b in range(bits - 1, 0, -1)):
        for i in range(n):
            high = (x[i] & q) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & (q - 1))
            x[0] ^= np.where(high, q - 1, swap)
            x[i] ^= swap
    for i in range(1, n):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    for q in (1 << b for b in range(bits - 1, 0, -1)):
        flip ^= np.where(x[n - 1] & q, q - 1, 0)
    x ^= flip
    place = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            place = place << 1 | x[i] >> b & 1
    return place


def _ranges(rows: DataFrame, scale: float) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
    """Of the most frequent vector length: the HILBERT_DIMS dimensions of greatest variance, their least and greatest values."""
    def run(batches):
        for batch in batches:
            for _, x in matrices(batch.column(0)):
                q, d = quantised(x, scale), x.shape[1]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(d, d, np.int32)), pa.array(np.arange(d, dtype=np.int32)), pa.array(np.full(d, float(len(q)))),
                                                  *(pa.array(v) for v in (q.min(axis=0), q.max(axis=0), q.sum(axis=0), (q * q).sum(axis=0)))], names=["d", "i", "n", "lo", "hi", "s", "s2"])
    parts = rows.select("vec").mapInArrow(run, "d int, i int, n double, lo double, hi double, s double, s2 double")
    stats = parts.groupBy("d", "i").agg(F.sum("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi"), (F.sum("s2") / F.sum("n") - F.pow(F.sum("s") / F.sum("n"), 2)).alias("var"))
    stats = written(stats, "op11-ranges")
    first = stats.filter("i = 0").orderBy(F.desc("n"), "d").first()
    if first is None:
        return 0, np.zeros(0, int), np.zeros(0), np.zeros(0)
    wide = stats.filter(F.col("d") == first["d"]).orderBy(F.desc("var"), "i").limit(HILBERT_DIMS).collect()
    return first["d"], np.array([r["i"] for r in wide]), np.array([r["lo"] for r in wide]), np.array([r["hi"] for r in wide])


def _placed(rows: DataFrame, scale: float) -> DataFrame:
    """id, label, whether an anchor, vector length, Hilbert place and packed integers of every row."""
    most, dims, lo, hi = _ranges(rows, scale)
    step = np.maximum(hi - lo, 1) / (1 << HILBERT_BITS)

    def run(batches):
        for batch in batches:
            for at, x in matrices(batch.column("vec")):
                q, part = quantised(x, scale), batch.take(pa.array(at))
                place = np.zeros(len(at), np.int64)
                if x.shape[1] == most and len(dims):
                    place = hilbert(np.clip((q[:, dims] - lo) / step, 0, (1 << HILBERT_BITS) - 1), HILBERT_BITS)
                yield pa.RecordBatch.from_arrays([part.column("id"), part.column("label"), part.column("anchor"), pa.array(np.full(len(at), x.shape[1], np.int32)),
                                                  pa.array(place), pa.array(packed(q.astype("<i4")), pa.binary())], names=["id", "label", "anchor", "d", "place", "q"])
    return rows.mapInArrow(run, "id bigint, label bigint, anchor boolean, d int, place bigint, q binary")


def _matrix(part: pa.RecordBatch, d: int) -> np.ndarray:
    return np.frombuffer(b"".join(part.column("q").to_pylist()), "<i4").reshape(part.num_rows, d)


def _blocks(placed: DataFrame) -> DataFrame:
    """The candidate blocks in Hilbert order, with their zone maps and the most rows of one id (``same``)."""
    def cut(batches):
        made = TaskContext.get().partitionId() << 32
        for (label, d), part in grouped(batches, ["label", "d"], BLOCK):
            q, ids = _matrix(part, d), part.column("id").to_numpy().astype("<i8")
            zone = [z.astype("<i4").tobytes() for z in (q.min(axis=0), q.max(axis=0))]
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in (
                (made, pa.int64()), (label, pa.int64()), (d, pa.int32()), (len(ids), pa.int32()), (int(np.unique(ids, return_counts=True)[1].max()), pa.int32()),
                (zone[0], pa.binary()), (zone[1], pa.binary()), (ids.tobytes(), pa.binary()), (q.tobytes(), pa.binary()))],
                names=["block", "label", "d", "n", "same", "lo", "hi", "ids", "q"])
            made += 1
    order = placed.repartitionByRange("label", "d", "place", "id").sortWithinPartitions("label", "d", "place", "id")
    return order.mapInArrow(cut, "block bigint, label bigint, d int, n int, same int, lo binary, hi binary, ids binary, q binary")


def _groups(placed: DataFrame) -> DataFrame:
    """Anchors near each other, GROUP in a row."""
    def cut(batches):
        made = TaskContext.get().partitionId() << 32
        for (d,), part in grouped(batches, ["d"], GROUP):
            cells = [part.column(c).to_numpy().astype("<i8").tobytes() for c in ("id", "label")]
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in ((made, pa.int64()), (d, pa.int32()), (cells[0], pa.binary()), (cells[1], pa.binary()), (_matrix(part, d).tobytes(), pa.binary()))],
                                             names=["g", "d", "ids", "labels", "q"])
            made += 1
    order = placed.filter("anchor").repartitionByRange("d", "label", "place", "id").sortWithinPartitions("d", "label", "place", "id")
    return order.mapInArrow(cut, "g bigint, d int, ids binary, labels binary, q binary")


def _pages(blocks: DataFrame) -> DataFrame:
    """Zone maps without vectors, up to PAGE blocks of one vector length in a row."""
    def pack(batches):
        made = TaskContext.get().partitionId() << 32
        for (d,), part in grouped(batches, ["d"], PAGE):
            cells = [part.column(c).to_numpy().astype("<i8").tobytes() for c in ("block", "label", "n")] + [b"".join(part.column(c).to_pylist()) for c in ("lo", "hi")]
            yield pa.RecordBatch.from_arrays([pa.array([made]), pa.array([d], pa.int32()), *(pa.array([c], pa.binary()) for c in cells)], names=["page", "d", "blocks", "labels", "sizes", "lo", "hi"])
            made += 1
    zones = blocks.select("block", "label", "d", (F.col("n") - F.col("same")).alias("n"), "lo", "hi").sortWithinPartitions("d")
    return zones.mapInArrow(pack, "page bigint, d int, blocks binary, labels binary, sizes binary, lo binary, hi binary")


class _Anchors:
    """A group of anchors with their windows: arrays (anchors, windows) lo and hi."""

    def __init__(self, row: dict, windows: int):
        self.q = unpacked(row["q"], row["d"], "<i4").astype(np.float64)
        self.ids, self.labels = np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["labels"], "<i8")
        if not row["d"]:
            self.q = np.zeros((len(self.ids), 0))
        self.lo, self.hi = np.full((len(self.ids), windows), np.inf), np.full((len(self.ids), windows), -np.inf)
        if row["wins"] is None:   # open windows
            self.lo[:], self.hi[:] = -np.inf, np.inf
        else:
            for w in row["wins"]:
                self.lo.flat[w["v"]], self.hi.flat[w["v"]] = w["lo"], w["hi"]
        for f in row.get("floors") or ():
            self.lo.flat[f["v"]] = max(self.lo.flat[f["v"]], f["least"])

    def bounds(self, page: dict):
        """(greatest, least score, whether the label fits by ``same``) of each anchor with each block of a page."""
        d = page["d"]
        lo, hi = (unpacked(page[c], d, "<i4").astype(np.float64) if d else np.zeros((len(page["blocks"]) // 8, 0)) for c in ("lo", "hi"))
        up, down = np.maximum(self.q, 0), np.minimum(self.q, 0)
        return up @ hi.T + down @ lo.T, up @ lo.T + down @ hi.T, self.labels[:, None] == np.frombuffer(page["labels"], "<i8")[None, :]


_WINDOW = "v int, lo double, hi double"


def _meetings(groups: DataFrame, pages: DataFrame) -> DataFrame:
    """Every group with every page of its vector length; the keys are paired first, then each side's row joined."""
    keys = groups.select("g", "d").join(pages.select("page", "d"), "d").select("g", "page")
    zones = pages.select("page", *(F.col(c).alias(f"p_{c}") for c in ("blocks", "labels", "sizes", "lo", "hi")))
    return keys.join(groups, "g").join(zones, "page")


def _each(batch: pa.RecordBatch, windows: int):
    for row in batch.to_pylist():
        yield row["g"], _Anchors(row, windows), {"d": row["d"], **{c[2:]: row[c] for c in row if c.startswith("p_")}}


def _floors(met: DataFrame, windows: int, k: int, same: bool) -> DataFrame:
    """(g, v, least): a score that at least ``k`` rows of window v reach: the least score of a block that lies in it whole."""
    def run(batches):
        for batch in batches:
            for g, a, page in _each(batch, windows):
                most, least, fits = a.bounds(page)
                enough = (fits == same) & (np.frombuffer(page["sizes"], "<i8") >= k)[None, :]
                best = np.stack([np.where(enough & (least >= a.lo[:, [w]]) & (most <= a.hi[:, [w]]), least, -np.inf).max(axis=1) for w in range(windows)], axis=1).ravel()
                v = np.flatnonzero(np.isfinite(best))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(v), g)), pa.array(v.astype(np.int32)), pa.array(best[v])], names=["g", "v", "least"])
    return met.mapInArrow(run, "g bigint, v int, least double").groupBy("g", "v").agg(F.max("least").alias("least"))


def _needed(met: DataFrame, windows: int, same: bool) -> DataFrame:
    """(g, block) for every block whose interval of scores meets a window of an anchor of the group."""
    def run(batches):
        for batch in batches:
            for g, a, page in _each(batch, windows):
                most, least, fits = a.bounds(page)
                meets = np.zeros(most.shape[1], bool)
                for w in range(windows):
                    meets |= ((fits == same) & (most >= a.lo[:, [w]]) & (least <= a.hi[:, [w]])).any(axis=0)
                blocks = np.frombuffer(page["blocks"], "<i8")[meets]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(blocks), g)), pa.array(blocks)], names=["g", "block"])
    return met.mapInArrow(run, "g bigint, block bigint")


class _Best:
    """The first ``k`` (score, id) of every window of a group."""

    def __init__(self, anchors: _Anchors, k: int, same: bool):
        self.a, self.k, self.same, self.least = anchors, k, same, anchors.lo.copy()
        self.v, self.s, self.id = np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64)

    def add(self, label: int, ids: np.ndarray, q: np.ndarray) -> None:
        fit = np.flatnonzero((self.a.labels == label) == self.same)
        if not len(fit):
            return
        score, n = self.a.q[fit] @ q.T, self.least.shape[1]
        for w in range(n):
            i, j = np.nonzero((score >= self.least[fit, w][:, None]) & (score <= self.a.hi[fit, w][:, None]))
            other = self.a.ids[fit[i]] != ids[j]
            i, j = i[other], j[other]
            if len(i):
                self._keep(fit[i] * n + w, score[i, j], ids[j])

    def _keep(self, v, s, ids) -> None:
        v, s, ids = np.concatenate((self.v, v)), np.concatenate((self.s, s)), np.concatenate((self.id, ids))
        order = np.lexsort((ids, -s, v))
        v, s, ids = v[order], s[order], ids[order]
        first = np.searchsorted(v, v)
        nth = np.arange(len(v)) - first
        keep = nth < self.k
        full = nth == self.k - 1
        self.v, self.s, self.id = v[keep], s[keep], ids[keep]
        self.least.flat[v[full]] = np.maximum(self.least.flat[v[full]], s[full])

    def rows(self, g: int) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(self.v), g)), pa.array(self.v.astype(np.int32)), pa.array(self.s.astype(np.int64)), pa.array(self.id)], names=["g", "v", "score", "id"])


def _search(groups: DataFrame, blocks: DataFrame, pages: DataFrame, windows: int, k: int, same: bool) -> DataFrame:
    """(g, v, rank, id, score): the first ``k`` rows of every window, of the anchor's label (``same``) or of others."""
    met = _meetings(groups, pages)
    floors = _floors(met, windows, k, same).groupBy("g").agg(F.collect_list(F.struct("v", "least")).alias("floors"))   # at most GROUP * windows
    groups = written(groups.join(floors, "g", "left"), "op11-windows")
    needed = _needed(_meetings(groups, pages), windows, same)
    spread = needed.select("g", "block", F.pmod(F.xxhash64("block"), F.lit(SPREAD)).cast("int").alias("part"))
    sent = spread.join(blocks.select("block", "label", "d", "ids", "q"), "block").select(
        "g", "part", F.lit(1).alias("kind"), "d", "label", "ids", F.lit(None).cast("binary").alias("labels"), "q",
        F.lit(None).cast(groups.schema["wins"].dataType).alias("wins"), F.lit(None).cast(groups.schema["floors"].dataType).alias("floors"))
    asked = groups.select("g", F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1))).alias("part"), F.lit(0).alias("kind"), "d", F.lit(None).cast("bigint").alias("label"),
                          "ids", "labels", "q", "wins", "floors")

    def scan(batches):
        at = best = None
        for batch in batches:
            for row in batch.to_pylist():
                if (row["g"], row["part"]) != at:
                    if best is not None:
                        yield best.rows(at[0])
                    at, best = (row["g"], row["part"]), _Best(_Anchors(row, windows), k, same)
                else:
                    ids = np.frombuffer(row["ids"], "<i8")
                    best.add(row["label"], ids, np.frombuffer(row["q"], "<i4").reshape(len(ids), row["d"]).astype(np.float64))
        if best is not None:
            yield best.rows(at[0])
    rows = asked.unionByName(sent).repartition("g", "part").sortWithinPartitions("g", "part", "kind")
    kept = rows.mapInArrow(scan, "g bigint, v int, score bigint, id bigint")
    nth = F.row_number().over(Window.partitionBy("g", "v").orderBy(F.desc("score"), "id"))
    return kept.withColumn("rank", nth).filter(F.col("rank") <= k)


def hard_negatives(rows: DataFrame, anchor: Column, id_col: str = "vec_id", vec: str = "embedding", label: str = "label", scale: float = 256,
                   positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score for the anchors (rows where ``anchor`` is true)."""
    v, g = F.col(f"`{vec}`"), F.col(f"`{label}`").cast("bigint")
    usable = rows.select(F.coalesce(F.col(f"`{id_col}`").cast("bigint"), F.lit(_NO_ID)).alias("id"), g.alias("label"), v.alias("vec"), F.coalesce(anchor, F.lit(False)).alias("anchor"))
    usable = usable.filter(F.col("label").isNotNull() & finite(F.col("vec")))
    placed = written(_placed(usable, scale), "op11-rows")
    blocks = written(_blocks(placed), "op11-blocks")
    pages = written(_pages(blocks), "op11-zones")
    groups = written(_groups(placed), "op11-anchors")

    open_windows = groups.withColumn("wins", F.lit(None).cast(f"array<struct<{_WINDOW.replace(' ', ':').replace(',:', ',')}>>"))
    found = written(_search(open_windows, blocks, pages, 1, positives, True), "op11-positives")
    # a window for each positive: its place is anchor * positives + rank
    place = (F.col("v") * positives + F.col("rank") - 1).cast("int").alias("v")
    ends = F.struct(place, (F.col("score") * F.lit(low) / 100).cast("double").alias("lo"), F.expr(f"cast(score * {high} div 100 as double)").alias("hi"))
    asked = groups.join(found.groupBy("g").agg(F.collect_list(ends).alias("wins")), "g")
    best = _search(asked, blocks, pages, positives, negatives, False)
    negative = best.select("g", F.col("v").alias("place"), "rank", F.col("id").alias("negative"), F.col("score").alias("negative_score"))
    positive = found.select("g", place.alias("place"), "v", F.col("id").alias("positive"), F.col("score").alias("positive_score"))
    each = groups.select("g", "ids")

    def named(batches):
        for batch in batches:
            for g, ids in zip(batch.column("g").to_pylist(), batch.column("ids").to_pylist()):
                ids = np.frombuffer(ids, "<i8")
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(ids), g)), pa.array(np.arange(len(ids), dtype=np.int32)), pa.array(ids)], names=["g", "v", "anchor_id"])
    anchors = each.mapInArrow(named, "g bigint, v int, anchor_id bigint")
    shown = lambda c: F.when(F.col(c) != _NO_ID, F.col(c))
    out = negative.join(positive, ["g", "place"]).join(anchors, ["g", "v"])
    return out.select("anchor_id", shown("positive").alias("positive_id"), "rank", shown("negative").alias("negative_id"), "positive_score", "negative_score")


#: DuckDB SQL for the query: every anchor with every row.
ORACLE = """
WITH ok AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
scored AS (
  SELECT a.vec_id AS a, b.vec_id AS b, a.label = b.label AS same, list_inner_product(a.q, b.q)::BIGINT AS s
  FROM ok a JOIN ok b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id AND len(a.q) = len(b.q)),
positives AS (SELECT * FROM scored WHERE same QUALIFY row_number() OVER (PARTITION BY a ORDER BY s DESC, b) <= 5)
SELECT p.a AS anchor_id, p.b AS positive_id, row_number() OVER (PARTITION BY p.a, p.b ORDER BY n.s DESC, n.b)::INTEGER AS rank, n.b AS negative_id,
  p.s AS positive_score, n.s AS negative_score
FROM positives p JOIN scored n ON p.a = n.a AND NOT n.same AND 50 * p.s <= 100 * n.s AND 100 * n.s <= 95 * p.s
QUALIFY row_number() OVER (PARTITION BY p.a, p.b ORDER BY n.s DESC, n.b) <= 3
"""
