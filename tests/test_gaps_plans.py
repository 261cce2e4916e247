"""Gap report / runs against brute force, and plan shape checks (broadcast dim, hash aggregates,
no cartesian products, pushed filters)."""

import datetime as dt

from pyspark.sql import functions as F

from candela.operators import gaps as G
from candela.operators.rollup import hourly_summary

T0 = dt.datetime(2024, 1, 10)


def _fixture(spark):
    dim = spark.createDataFrame([(1, "A", None), (2, "B", None), (3, "EMPTY", None)],
                                "symbol_id int, symbol string, tracking_start_ts string")
    present = []
    for i in range(0, 7 * 1440, 1):
        ts = T0 - dt.timedelta(days=7) + dt.timedelta(minutes=i)
        if i % 13 not in (3, 4, 5):
            present.append((1, ts))
        if i % 977 != 0 and not (2000 <= i < 2100):
            present.append((2, ts))
    present.append((1, T0 + dt.timedelta(hours=5)))   # today: outside the parity window
    fact = spark.createDataFrame(present, "symbol_id int, timestamp_key timestamp")
    return dim, fact, {(s, t) for s, t in present}


def _brute(present, start, end):
    out = set()
    t = start
    while t < end:
        for sid, sym in ((1, "A"), (2, "B"), (3, "EMPTY")):
            if (sid, t) not in present:
                out.add((sym, t))
        t += dt.timedelta(minutes=1)
    return out


def test_gap_report_matches_brute_force(spark):
    dim, fact, present = _fixture(spark)
    as_of = T0 + dt.timedelta(hours=13, minutes=27)
    got = {(r.symbol, r.missing_minute) for r in G.gap_report(fact, dim, as_of).collect()}
    want = _brute(present, T0 - dt.timedelta(days=7), T0)
    assert got == want
    assert sum(1 for s, _ in got if s == "EMPTY") == 10080


def test_gap_runs_fold_the_report(spark):
    dim, fact, present = _fixture(spark)
    as_of = T0 + dt.timedelta(hours=1)
    report = sorted((r.symbol, r.missing_minute) for r in G.gap_report(fact, dim, as_of).collect())
    runs = G.gap_runs(fact, dim, as_of).collect()
    expanded = sorted((r.symbol, r.run_start + dt.timedelta(minutes=k)) for r in runs for k in range(r.n_missing))
    assert expanded == report
    assert all(r.run_end == r.run_start + dt.timedelta(minutes=r.n_missing - 1) for r in runs)


def test_sparse_form_equals_matrix_form(spark):
    dim, fact, present = _fixture(spark)
    for as_of, today in ((T0 + dt.timedelta(hours=13), False), (T0 + dt.timedelta(hours=6, seconds=30), True)):
        a = sorted(G.gap_report(fact, dim, as_of, include_today=today).collect())
        b = sorted(G.gap_report_sparse(fact, dim, as_of, include_today=today).collect())
        assert a == b


def test_include_today_window(spark):
    dim, fact, present = _fixture(spark)
    as_of = T0 + dt.timedelta(hours=6, seconds=30)
    got = {(r.symbol, r.missing_minute) for r in G.gap_report(fact, dim, as_of, include_today=True).collect()}
    start, end = G.window_bounds(as_of, include_today=True)
    assert end == T0 + dt.timedelta(hours=6, minutes=1)
    assert got == _brute(present, start, end)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_gap_report_has_no_cartesian_product(spark):
    dim, fact, _ = _fixture(spark)
    plan = _plan(G.gap_report(fact, dim, T0))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_fact_join_broadcasts_checked_dim_and_rollup_hash_aggregates(spark):
    from candela.plans import catalog as C
    d = "/root/testdata/sf0.001"
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        from candela.operators.fact import fact_klines
        fact = fact_klines(C.valid_frame(spark, d), C.dim_frame(spark, d))
        assert "BroadcastHashJoin" in _plan(fact)
        plan = _plan(hourly_summary(C.fact_frame(spark, d)))
        assert "HashAggregate" in plan and "SortAggregate" not in plan
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_silver_scan_prunes_and_pushes(spark):
    from candela.plans import catalog as C
    d = "/root/testdata/sf0.001"
    fact = C.fact_frame(spark, d)
    q = fact.filter((F.col("fact_date") == F.lit("2024-01-05").cast("date")) & (F.col("symbol_id") == 3)).select("close")
    plan = _plan(q)
    assert "PartitionFilters: [isnotnull(fact_date" in plan
    assert "PushedFilters: [IsNotNull(symbol_id), EqualTo(symbol_id,3)]" in plan
    assert "ReadSchema: struct<symbol_id:int,close:decimal(18,8)>" in plan


def test_respect_listing_skips_minutes_before_tracking_start(spark):
    dim, fact, present = _fixture(spark)
    start_b = T0 - dt.timedelta(days=2)
    dim = dim.withColumn("tracking_start_ts", F.when(F.col("symbol") == "EMPTY",
                                                     F.lit(start_b.strftime("%Y-%m-%d %H:%M:%S"))))
    got = G.gap_report(fact, dim, T0, respect_listing=True)
    assert got.filter(F.col("symbol") == "EMPTY").count() == 2 * 1440


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_valid_rows_push_their_rules_to_the_scan(spark):
    from candela.plans.catalog import valid_frame
    plan = _plan(valid_frame(spark, "/root/testdata/sf0.001"))
    assert "IsNotNull(high), IsNotNull(low), GreaterThan(close,0" in plan  # the printed list ends soon after


def test_gap_runs_read_the_fact_once(spark):
    from candela.plans.catalog import as_of, dim_frame, fact_frame
    d = "/root/testdata/sf0.001"
    plan = _plan(G.gap_runs(fact_frame(spark, d), dim_frame(spark, d), as_of(spark, d)))
    assert plan.count("fact_date") > 0 and plan.count("Exchange ") == 1 and plan.count("FileScan parquet [symbol_id#") == 1


def test_monitors_prune_by_arrival_date(spark):
    from candela.operators.monitors import QUARANTINE, SCHEMA_DRIFT
    from candela.plans.catalog import as_of, bronze_table, quarantine_table
    d = "/root/testdata/sf0.001"
    for monitor, rows in ((SCHEMA_DRIFT, bronze_table(spark, d)), (QUARANTINE, quarantine_table(spark, d))):
        assert "PartitionFilters: [isnotnull(ingest_date" in _plan(monitor.evaluate(rows, as_of(spark, d)))
