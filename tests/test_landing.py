"""Landed files, published tables, monitor history, mergeable rollups, late rows."""

import datetime as dt
import io
import zipfile

import pytest
from pyspark.sql import functions as F

from candela import schemas as S
from candela.operators import rollup as R
from candela.operators.expectations import ExpectationError, publish
from candela.operators.monitors import Monitor, history
from candela.operators.serve import dim_time_of, join_dim_time
from candela.plans.layers import table_tags, write_table
from candela.sources import archives as Z
from candela.sources.metadata import read_symbol_metadata, write_symbol_metadata
from candela.streaming import live as L

T0 = dt.datetime(2024, 1, 1)


def at(minutes):
    return T0 + dt.timedelta(minutes=minutes)


def test_archives_land_as_files_and_outcomes_are_one_a_file(spark, tmp_dir):
    def zipped(*names_and_texts):
        buf = io.BytesIO()
        with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
            for n, t in names_and_texts:
                z.writestr(n, t)
        return buf.getvalue()
    line = "1704067200000,1.0,2.0,0.5,1.5,10,1704067259999,15,7,4,6,0"
    good = zipped(("a.csv", f"{line}\n{line}\n"), ("b.csv", "not read\n"))
    rows = [("AAA", 2024, 1, good), ("A B", 2024, 2, zipped(("a.csv", ""))), (None, 2024, 3, good), ("BAD", 2024, 1, good[:len(good) // 2]), ("NONE", 2024, 1, zipped()),
            ("RAW", 2024, 1, bytes(range(256)) * 20)]
    Z.write_archives(spark.createDataFrame(rows, "symbol string, year int, month int, content binary"), f"{tmp_dir}/zips")
    read = Z.read_zip_archives(spark, f"{tmp_dir}/zips", "*")
    got = {r.symbol: (r.year, r.month, r.status.split(" ")[0]) for r in Z.archive_outcomes(read).collect()}
    assert got == {"AAA": (2024, 1, "SUCCESS"), "A B": (2024, 2, "SUCCESS"), None: (2024, 3, "SUCCESS"), "BAD": (2024, 1, "FAILED"), "NONE": (2024, 1, "FAILED"), "RAW": (2024, 1, "FAILED")}
    candles = Z.archive_rows(read).collect()
    assert sorted((r.symbol or "", r.close) for r in candles) == [("", "1.5"), ("", "1.5"), ("AAA", "1.5"), ("AAA", "1.5")]


def test_metadata_document_keeps_order_and_nulls(spark, tmp_dir):
    rows = [(s, "TRADING", None, 8, "USDT", None, None) for s in ("b", "a", "c \"quoted\"", "é")]
    write_symbol_metadata(spark.createDataFrame(rows, S.SYMBOL_RECORD).repartition(3), f"{tmp_dir}/doc")
    assert len(spark.read.text(f"{tmp_dir}/doc").collect()) > 4      # several lines
    got = read_symbol_metadata(spark, f"{tmp_dir}/doc", position="nth").orderBy("nth").collect()
    assert [(r.nth, r.symbol, r.base_asset, r.base_precision) for r in got] == [(i, s, None, 8) for i, s in enumerate(sorted(r[0] for r in rows))]


def test_nothing_is_published_on_violation(spark, tmp_dir):
    path, rules = f"{tmp_dir}/t", [("has_a", "a IS NOT NULL"), ("small", "a < 10")]
    df = lambda *v: spark.createDataFrame([(x,) for x in v], "a int")
    assert publish(df(1, 2), path, rules) == {"n_rows": 2, "has_a": 0, "small": 0}
    with pytest.raises(ExpectationError) as e:
        publish(df(1, None, 50), path, rules)
    assert e.value.counts == {"n_rows": 3, "has_a": 1, "small": 2}
    assert sorted(r.a for r in spark.read.parquet(path).collect()) == [1, 2]
    import os
    assert os.listdir(tmp_dir) == ["t"]
    assert publish(df(3), path, rules)["n_rows"] == 1 and [r.a for r in spark.read.parquet(path).collect()] == [3]
    assert publish(df(), path, rules) == {"n_rows": 0, "has_a": 0, "small": 0}


def test_history_is_the_monitor_at_every_instant(spark):
    times = [at(m) + dt.timedelta(seconds=s) for m, s in ((0, 0), (4, 59), (5, 0), (5, 1), (5, 1), (15, 0), (62, 30))] + [None]
    rows = spark.createDataFrame([(t, i % 2 == 0) for i, t in enumerate(times)], "ts timestamp, odd boolean")
    for m in (Monitor("all", "ts", "15 minutes", 2, "WARNING"), Monitor("some", "ts", "1 hour", 0, "CRITICAL", "odd")):
        got = {r.as_of: (r.observed, r.triggered) for r in history([(m, rows)], at(-10), at(130)).collect()}
        assert len(got) == 29
        for t, said in got.items():
            one = m.evaluate(rows.filter(F.col("ts") <= F.lit(str(t)).cast("timestamp")), t).first()
            assert said == (one.observed, one.triggered), t
    with pytest.raises(ValueError):
        Monitor("m", "ts", "7 minutes", 0, "x").counts_at(rows, 300)


def test_days_from_hours_equal_days_from_minutes(spark):
    money = lambda c: F.col(c).cast(S.PRICE).alias(c)
    rows = [(s, at(7 * i), 1.0 + i % 13, 20.0 + i % 7, 0.5 + i % 3, 2.0 + i % 11, 1.0 + i % 5, 3.0 * i, i % 4, 0.5) for s in (1, 2) for i in range(0, 700, s)]
    cols = ["open", "high", "low", "close", "volume", "quote_asset_volume", "taker_buy_base_vol"]
    fact = spark.createDataFrame(rows, "symbol_id int, timestamp_key timestamp, open double, high double, low double, close double, volume double, "
                                       "quote_asset_volume double, number_of_trades int, taker_buy_base_vol double").select("symbol_id", "timestamp_key", "number_of_trades", *map(money, cols))
    hours = R.partials(fact, "hour")
    assert R.summary(hours, "hour").exceptAll(R.hourly_summary(fact)).count() == 0
    days = R.summary(R.merge_partials(hours, "day"), "day")
    assert days.schema == R.daily_summary(fact).schema
    assert days.exceptAll(R.daily_summary(fact)).count() == 0 and days.count() == R.daily_summary(fact).count()
    plan = R.merge_partials(hours, "day")._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan


def test_late_rows_are_diverted_once(spark, tmp_dir):
    schema = "symbol string, open_time_ts timestamp, is_final boolean, v int"
    paths = L.Paths(tmp_dir)
    feed = [[("A", at(60), True, 1), ("A", at(60), True, 2), ("A", at(61), False, 3)],
            [("A", at(55), True, 4), ("A", at(40), True, 5), ("A", at(60), True, 6), ("B", at(100), True, 7)],   # at(40) is behind at(60) - 10
            [("A", at(40), True, 8), ("B", at(95), True, 9), ("A", at(89), True, 10), (None, at(120), True, 11)],
            []]
    for rows in feed:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(paths.input)
        L.run_dedup(spark, lambda: spark.readStream.schema(schema).parquet(paths.input), paths)
    late = sorted(r.v for r in spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(paths.late).collect() if r.symbol)
    assert late == [5, 8, 10]
    kept = sorted((r.symbol or "", r.open_time_ts) for r in spark.read.parquet(paths.deduped).collect())
    assert kept == [("", at(120)), ("A", at(55)), ("A", at(60)), ("B", at(95)), ("B", at(100))]


def test_star_join_is_merged_and_keeps_every_row(spark):
    fact = spark.createDataFrame([(1, at(0)), (2, at(1441)), (2, at(1441)), (3, None)], "symbol_id int, timestamp_key timestamp").withColumn("fact_date", F.to_date("timestamp_key"))
    joined = join_dim_time(fact, dim_time_of(fact))
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
    assert sorted((r.symbol_id, r.hour, r.minute, r.day_name) for r in joined.collect() if r.timestamp_key) == [(1, 0, 0, "Monday"), (2, 0, 1, "Tuesday"), (2, 0, 1, "Tuesday")]
    assert joined.count() == 4
    assert dim_time_of(fact.limit(0)).count() == 0


def test_tables_carry_their_tags(spark, tmp_dir):
    path = write_table(spark.range(3).withColumn("d", F.current_date()), f"{tmp_dir}/t", ["d"], ["id"], {"quality": "gold", "comment": "numbers"})
    assert table_tags(spark.read.parquet(path)) == {"quality": "gold", "comment": "numbers"}
    assert table_tags(spark.range(1)) == {}
