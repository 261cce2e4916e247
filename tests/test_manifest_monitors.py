"""Backfill months, landed-month skipping, outcome counts, and monitor thresholds."""

import datetime as dt

from candela.operators import manifest as M
from candela.operators.monitors import Monitor


def test_month_series_and_skip(spark):
    listings = spark.createDataFrame(
        [("AAA", dt.datetime(2024, 11, 15)), ("NEW", dt.datetime(2024, 12, 20)), ("UNK", None)],
        "symbol string, first_ts timestamp")
    as_of = dt.datetime(2025, 1, 10)
    exp = M.month_series(listings, as_of)
    got = sorted((r.symbol, r.year, r.month) for r in exp.collect())
    # NEW is listed in the last closed month (Dec 2024) -> one month; UNK falls back to 2017-08
    assert ("AAA", 2024, 11) in got and ("AAA", 2024, 12) in got and ("AAA", 2025, 1) not in got
    assert [g for g in got if g[0] == "NEW"] == [("NEW", 2024, 12)]
    assert sum(1 for g in got if g[0] == "UNK") == (2024 - 2017) * 12 + (12 - 8) + 1
    assert exp.filter("symbol = 'AAA' AND month = 11").first().path == "raw_klines/symbol=AAA/year=2024/month=11.csv"
    landed = spark.createDataFrame([("AAA", 2024, 11)], "symbol string, year int, month int")
    todo = sorted((r.symbol, r.year, r.month) for r in M.to_fetch(exp, landed).filter("symbol = 'AAA'").collect())
    assert todo == [("AAA", 2024, 12)]
    avail = spark.createDataFrame([("AAA", 2024, 12)], "symbol string, year int, month int")
    status = {(r.symbol, r.month): r.status for r in M.month_status(exp.filter("symbol = 'AAA'"), landed, avail).collect()}
    assert status == {("AAA", 11): "SKIPPED", ("AAA", 12): "SUCCESS"}
    st = spark.createDataFrame([("SUCCESS",), ("FAILED (bad ZIP)",), ("FAILED (HTTP 500)",), ("SKIPPED",)], "status string")
    assert {r.status: r.n_tasks for r in M.status_summary(st).collect()} == {"SUCCESS": 1, "FAILED": 2, "SKIPPED": 1}


def test_last_closed_month():
    assert M.last_closed_month(dt.date(2024, 1, 5)) == dt.date(2023, 12, 1)
    assert M.last_closed_month(dt.datetime(2024, 3, 31, 23, 59)) == dt.date(2024, 2, 1)


def test_monitor_threshold_and_window(spark):
    now = dt.datetime(2024, 1, 1, 12, 0)
    rows = spark.createDataFrame([(now - dt.timedelta(minutes=m),) for m in (1, 5, 10, 14, 16, 90)], "ts timestamp")
    m = Monitor("recent", "ts", "15 minutes", 3, "WARNING")
    r = m.evaluate(rows, now).first()
    assert (r.observed, r.triggered, r.severity) == (4, True, "WARNING")
    r = Monitor("recent", "ts", "15 minutes", 4, "WARNING").evaluate(rows, now).first()
    assert (r.observed, r.triggered) == (4, False)
