"""Dimensions (full minute span, hash ids) and abort-on-violation expectations."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from candela.operators.dims import dim_symbol, dim_time, minute_series
from candela.operators.expectations import count_violations, expect_or_fail


def test_dim_time_default_span(spark):
    d = dim_time(spark)
    row = d.agg(F.count(F.lit(1)).alias("n"), F.min("timestamp_key").alias("lo"), F.max("timestamp_key").alias("hi")).first()
    assert row.n == 4_953_601
    assert (row.lo, row.hi) == (dt.datetime(2017, 8, 1), dt.datetime(2027, 1, 1))
    assert minute_series(spark, "2024-01-01 00:00:00", "2024-01-01 01:00:00").rdd.getNumPartitions() >= 1


def test_dim_time_attributes(spark):
    d = dim_time(spark, "2024-01-06 07:59:00", "2024-01-06 08:00:00").orderBy("timestamp_key").collect()
    a, b = d
    assert (a.day_name, a.day_name_short, a.day_of_week, a.is_weekend, a.trading_session) == ("Saturday", "Sat", 7, True, "Asia")
    assert (b.hour, b.trading_session, b.quarter, b.date) == (8, "Europe", 1, dt.date(2024, 1, 6))


def test_hash_ids_are_stable_when_symbols_are_added(spark):
    recs = spark.createDataFrame([("AAA",), ("CCC",)], "symbol string")
    cols = ["status", "base_asset", "base_precision", "quote_asset", "quote_precision", "tracking_start_ts"]
    recs = recs.select("symbol", *[F.lit(None).cast("string" if "precision" not in c else "long").alias(c) for c in cols])
    more = recs.unionByName(recs.limit(1).withColumn("symbol", F.lit("BBB")))
    a = {r.symbol: r.symbol_id for r in dim_symbol(recs, "hash").collect()}
    b = {r.symbol: r.symbol_id for r in dim_symbol(more, "hash").collect()}
    assert a["AAA"] == b["AAA"] and a["CCC"] == b["CCC"] and len(set(b.values())) == 3
    seq = {r.symbol: r.symbol_id for r in dim_symbol(more).collect()}
    assert seq == {"AAA": 1, "BBB": 2, "CCC": 3}


def test_expect_or_fail(spark):
    ok = spark.createDataFrame([(1, dt.datetime(2024, 1, 1))], "symbol_id int, timestamp_key timestamp")
    bad = spark.createDataFrame([(1, dt.datetime(2024, 1, 1)), (None, dt.datetime(2024, 1, 1))],
                                "symbol_id int, timestamp_key timestamp")
    rules = [("valid_symbol_key", "symbol_id IS NOT NULL"), ("valid_time_key", "timestamp_key IS NOT NULL")]
    assert expect_or_fail(ok, rules).count() == 1
    with pytest.raises(Exception, match="valid_symbol_key"):
        expect_or_fail(bad, rules).collect()
    assert count_violations(bad, rules) == {"valid_symbol_key": 1, "valid_time_key": 0}


def test_sequence_ids_are_dense_beyond_a_sampling_window(spark):
    from candela.functions.ids import dense_sequence_id
    rows = spark.range(200_000, numPartitions=8).selectExpr("md5(cast(id as string)) AS k", "id AS carried", "repeat('x', cast(id % 50 as int)) AS more")
    out = dense_sequence_id(rows, ["k"], num_partitions=8).selectExpr(
        "count(*) AS n", "count(distinct id) AS d", "max(id) AS hi", "min(id) AS lo").first()
    assert (out.n, out.d, out.hi, out.lo) == (200_000, 200_000, 200_000, 1)


def test_prepare_is_idempotent(spark):
    import __spark_entry__ as E
    from candela.session import ship_package
    for _ in range(3):
        ship_package(spark)
        E._prepare(spark)
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    assert spark.conf.get("spark.checkpoint.dir")
