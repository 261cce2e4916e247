"""Small tables between the steps cost few jobs and files, whatever the number of shuffle partitions."""
from contextlib import contextmanager

import numpy as np
from pyspark.sql import functions as F

from candela.llm import bitmap, graph
from candela.llm import linedup as L


@contextmanager
def dealt(spark, n):
    """``n`` shuffle partitions that are not put together again, as where each holds much."""
    conf = {"spark.sql.shuffle.partitions": str(n), "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    was = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in was.items():
            spark.conf.set(k, v)


def jobs(spark, name, act):
    spark.sparkContext.setJobGroup(name, name)
    try:
        return act(), len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_a_bitmap_takes_as_many_jobs_at_any_number_of_partitions(spark):
    rows = spark.range(3000).select(F.xxhash64("id").alias("h"))
    h = np.array([r.h for r in rows.collect()]).astype(np.uint64)
    other = np.random.default_rng(3).integers(0, 2**64, 5000, dtype=np.uint64)
    at = lambda x: x >> np.uint64(64 - bitmap.BITS)
    with dealt(spark, 40):
        bits, n = jobs(spark, "bitmap", lambda: bitmap.build(rows, "h"))
        assert n <= 3
        empty = bitmap.build(rows.filter("h is null"), "h")
    assert bitmap.holds(bits.value, h).all() and (bitmap.holds(bits.value, other) == np.isin(at(other), at(h))).all()
    assert not empty.value.any()


def test_bitmap_pieces_are_not_stored(spark, monkeypatch):
    """Lines of ten words, each with one of the same words changed: every table written between the steps is read in more than one step."""
    names = []
    monkeypatch.setattr(L, "written", lambda df, name, f=L.written: (names.append(name), f(df, name))[1])
    rows = [(i, f"a b c d e f{i} g h i j k\nsingle line number {i}") for i in range(6)] + [(9, None), (None, "a b c d e f g h i j k")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.doc_id: (r.text, r.n_dropped) for r in L.dedup_lines(df).collect()}
    assert got[0] == (rows[0][1], 0) and got[9] == (None, 0) and got[None] == ("", 1)
    assert all(got[i] == (f"single line number {i}", 1) for i in range(1, 6))
    assert "op7-bitmap" not in names and {"op7-lines", "op7-halves", "op7-variants"} <= set(names)


def test_rounds_of_components_write_files_by_rows(spark, monkeypatch):
    paths = []

    def written(df, name, f=graph.written):
        out = f(df, name)
        paths.append(len(out.inputFiles()))
        return out
    monkeypatch.setattr(graph, "written", written)
    links = [(10 * c + i, 10 * c + i + 1) for c in range(200) for i in range(5)]
    links = spark.createDataFrame(links, "a bigint, b bigint")
    expect = {10 * c + i: 10 * c for c in range(200) for i in range(6)}
    with dealt(spark, 40):
        assert {r.node: r.label for r in graph.components(links).collect()} == expect
        assert len(paths) > 1 and max(paths[1:]) <= graph.FILES
        paths.clear()
        monkeypatch.setattr(graph, "FILE_ROWS", 50)
        assert {r.node: r.label for r in graph.components(links).collect()} == expect
        assert max(paths[1:]) > graph.FILES
