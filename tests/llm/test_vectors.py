import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from candela.llm import hardneg as H
from candela.llm import vecdup as V

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def usable(v, nonzero=True):
    return v is not None and all(x is not None and math.isfinite(x) for x in v) and (not nonzero or any(x != 0 for x in v))


def vectors(n, d, seed, copies=3):
    """Random unit vectors, crowds of near copies, exact copies and rows with faults."""
    rng, rnd = np.random.default_rng(seed), random.Random(seed)
    rows = []
    for i in range(n):
        x = rng.normal(size=d)
        if i % 3 == 0:      # a crowd around few centres
            x = np.sin(np.arange(d) * (1 + i % 2)) + rng.normal(size=d) * rng.choice([0.05, 0.3, 0.4])
        if i % 10 == 1 and rows:
            x = np.array(rnd.choice(rows)[1]) * rng.choice([1, 2.5])
        rows.append((i, [float(y) for y in np.float32(x / np.sqrt((x * x).sum()))], rnd.choice([0, 0, 0, 1, 2])))
    rows += [(1000 + i, rows[0][1], rows[0][2]) for i in range(copies)]
    odd = [None, [], [0.0] * d, [None] + rows[1][1][1:], [float("nan")] + rows[1][1][1:], [float("inf")] + rows[1][1][1:], rows[1][1][:-1], rows[1][1][:-1], [-0.0] + rows[2][1][1:]]
    rows += [(2000 + i, v, 0) for i, v in enumerate(odd)] + [(2100, rows[0][1], None), (None, rows[0][1], rows[0][2]), rows[0], rows[50]]
    return rows


def brute_near(rows, cosine=0.93):
    def unit(v):
        v = np.array(v, float)
        return v / np.sqrt((v * v).sum())
    u = [unit(v) if g is not None and usable(v) else None for _, v, g in rows]
    near = [[j for j in range(len(rows)) if j != i and u[i] is not None and u[j] is not None and rows[i][2] == rows[j][2] and len(u[i]) == len(u[j])
             and u[i] @ u[j] >= cosine] for i in range(len(rows))]
    out = []
    for i, (d, _, _) in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            todo += [j for j in near[todo.pop()] if j not in seen and not seen.add(j)]
        out.append((d, len(near[i]), min((rows[j][0] for j in seen if rows[j][0] is not None), default=None)))
    return sorted(out, key=str)


def near(spark, rows, **kw):
    got = V.near_vectors(spark.createDataFrame(rows, SCHEMA), **kw)
    assert got.columns == ["id", "n_links", "component_id"]
    return sorted((tuple(r) for r in got.collect()), key=str)


def test_near_vectors_match_brute_force(spark, monkeypatch):
    rows = vectors(260, 24, 1)
    want = brute_near(rows)
    assert near(spark, rows) == want
    assert max(n for _, n, _ in want) > 10 and sum(n == 0 for _, n, _ in want) > 50
    monkeypatch.setattr(V, "TILE", 16)      # many tiles, and strips and pieces smaller than they are
    monkeypatch.setattr(V, "STRIP", 5)
    monkeypatch.setattr(V, "GATHER", 7)
    assert near(spark, rows) == want
    assert near(spark, rows, cosine=0.5) == brute_near(rows, 0.5)


def test_far_tiles_never_meet(spark, monkeypatch):
    """Vectors around two opposite centres: no tile of one is compared with a tile of the other."""
    monkeypatch.setattr(V, "TILE", 8)
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in (1 if i % 2 else -1) * np.ones(8) + rng.normal(size=8) * 0.02], 1) for i in range(64)]
    keyed = V._keyed(spark.createDataFrame(rows, SCHEMA), "vec_id", "embedding", "label")
    classes = keyed.groupBy("cls", "label", "vec").agg(V.F.count("*").alias("n"), V.F.min("id").alias("first")).cache()
    axes = spark.sparkContext.broadcast(V.principal_axes(classes))
    tiles = V.written(V._tiles(classes, axes), "tiles")
    n, pairs = tiles.count(), V._tile_pairs(tiles, 0.93).collect()
    assert n >= 8 and len(pairs) <= 2 * (n / 2) * (n / 2 + 1) / 2 < n * (n + 1) / 2
    assert near(spark, rows) == brute_near(rows)


def test_close_stops_early_and_finds_all():
    rng = np.random.default_rng(5)
    x, y = (V._unit(np.cos(np.outer(rng.normal(size=n), np.arange(1, 41))) + rng.normal(size=(n, 40)) * 0.2) for n in (90, 70))
    axes = {40: np.linalg.eigh(x.T @ x)[1][:, ::-1]}
    got = {(i, j) for lo in range(0, 90, V.STRIP) for i, j in zip(*map(np.ndarray.tolist, V._close(x, y, V._turned(x, axes), V._turned(y, axes), 0.9, lo)))}
    assert got == {(i, j) for i, j in itertools.product(range(90), range(70)) if x[i] @ y[j] >= 0.9} and got


def test_forest_spans():
    rng = np.random.default_rng(6)
    for _ in range(30):
        n = 30
        i, j = rng.integers(0, n, 25), rng.integers(0, n, 25)
        forest = V.Forest(np.arange(n))
        forest.add(i[:10], j[:10])
        forest.add(i[10:], j[10:])
        links = [(a, b) for x, y in forest.links for a, b in zip(x, y)]
        def parts(pairs):
            lab = list(range(n))
            for a, b in pairs:
                lab = [lab[a] if v == lab[b] else v for v in lab]
            return [[k for k in range(n) if lab[k] == v] for v in sorted({*lab})]
        whole = parts(zip(i, j))
        assert sorted(map(tuple, parts(links))) == sorted(map(tuple, whole)) and len(links) == n - len(whole)


def test_extreme_sizes_and_empty_table(spark):
    rows = [(1, [1e300, 1e300], 1), (2, [1e-300, 1e-300], 1), (3, [1e300, -1e300], 1), (4, [5e-324, 5e-324], 1)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")
    assert sorted(tuple(r) for r in V.near_vectors(df).collect()) == [(1, 2, 1), (2, 2, 1), (3, 0, 3), (4, 2, 1)]
    assert V.near_vectors(df.limit(0)).collect() == []
    odd = df.selectExpr("*", "'a' as cls", "1 as n", "2 as d", "3 as links", "4 as first")
    assert len(V.near_vectors(odd).collect()) == 4


# -- hard negatives ---------------------------------------------------------------------------------

def brute_hard(rows, anchors, positives=5, negatives=3, low=50, high=95, scale=256):
    ok = [(i, [math.floor(scale * x) for x in v], g) for i, v, g in rows if g is not None and usable(v, False)]
    last = lambda i: (i is None, i or 0)
    out = []
    for i, q, g in ok:
        if i is None or not anchors(i):
            continue
        scored = sorted(((sum(x * y for x, y in zip(q, p)), j, h) for j, p, h in ok if j != i and len(p) == len(q)), key=lambda x: (-x[0], last(x[1])))
        for s, j, _ in [x for x in scored if x[2] == g][:positives]:
            hard = [x for x in scored if x[2] != g and low * s <= 100 * x[0] <= high * s][:negatives]
            out += [(i, j, k + 1, n, s, t) for k, (t, n, _) in enumerate(hard)]
    return sorted(out, key=str)


def hard(spark, rows, **kw):
    got = H.hard_negatives(spark.createDataFrame(rows, SCHEMA), H.F.col("vec_id") % 5 == 0, **kw)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted((tuple(r) for r in got.collect()), key=str)


def test_hard_negatives_match_brute_force(spark, monkeypatch):
    rows = vectors(200, 12, 2)
    rows = [(i, v, g if g != 2 else 1) for i, v, g in rows]
    want = brute_hard(rows, lambda i: i % 5 == 0)
    assert hard(spark, rows) == want and len(want) > 200
    for name, size in (("BLOCK", 7), ("GROUP", 9), ("PAGE", 4), ("SPREAD", 3)):
        monkeypatch.setattr(H, name, size)
    assert hard(spark, rows) == want
    assert hard(spark, rows, positives=2, negatives=1, low=30, high=80, scale=16) == brute_hard(rows, lambda i: i % 5 == 0, 2, 1, 30, 80, 16)


def test_ties_go_by_id_and_windows_are_exact(spark):
    rows = [(i, [1.0, 0.0], 1) for i in (5, 3, 1, 9, 7)] + [(20 + i, [x, 0.0], 2) for i, x in enumerate((0.5, 0.95, 0.949, 0.951, 0.499, 0.95, 0.95, 0.5, 0.7))]
    assert hard(spark, rows) == brute_hard(rows, lambda i: i % 5 == 0)


def test_bounds_leave_blocks_out(spark, monkeypatch):
    """Rows around far centres: the zone maps keep most blocks from being read."""
    for name, size in (("BLOCK", 8), ("GROUP", 4)):
        monkeypatch.setattr(H, name, size)
    rng = np.random.default_rng(7)
    centres = np.eye(6) * 4
    rows = [(i, [float(x) for x in centres[i % 6] + rng.normal(size=6) * 0.1], i % 6 // 2) for i in range(300)]
    read = []
    needed = H._needed
    monkeypatch.setattr(H, "_needed", lambda met, w, same: read.append(n := H.written(needed(met, w, same), "n")) or n)
    assert hard(spark, rows) == brute_hard(rows, lambda i: i % 5 == 0)
    groups = 60 / 4
    blocks = 300 / 8
    assert 0 < read[0].count() < groups * blocks / 3


def test_hilbert_steps_to_a_neighbour():
    for n, bits in ((2, 4), (3, 3), (5, 2)):
        cells = np.array(list(itertools.product(range(1 << bits), repeat=n)))
        place = H.hilbert(cells, bits)
        assert sorted(place.tolist()) == list(range(len(cells)))
        assert (np.abs(np.diff(cells[np.argsort(place)], axis=0)).sum(axis=1) == 1).all()


@pytest.mark.parametrize("rows", [[], [(1, [1.0], 1)], [(5, [1.0], 1)], [(5, [], 1), (6, [], 1), (7, [], 2)], [(5, [1e30, 1.0], 1), (6, [1e30, 1.0], 1), (7, [7e29, 1.0], 2)]])
def test_small_tables(spark, rows):
    got = hard(spark, rows)
    if not rows or len(rows[0][1]) < 2:
        assert got == brute_hard(rows, lambda i: i % 5 == 0)
    odd = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as q", "2 as d", "3 as g", "4 as id")
    assert sorted((tuple(r) for r in H.hard_negatives(odd, H.F.col("vec_id") % 5 == 0).collect()), key=str) == got


def test_class_names_are_in_the_order_of_their_ids(spark):
    ids = [None, 0, -1, 1, 7, -(1 << 63), (1 << 63) - 1, 1 << 40]
    rows = spark.createDataFrame([(i,) for i in ids], "id bigint").withColumn("name", V._name(F.col("id"), F.lit("k" * V.KEY)))
    got = rows.withColumn("back", V._named_id(F.col("name"))).orderBy("name").collect()
    assert [r.id for r in got] == [*sorted(i for i in ids if i is not None), None]
    assert all(r.id == r.back and len(r.name) == V.NAME for r in got)
