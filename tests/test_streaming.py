"""Streaming fixtures: late data against the dedup watermark, hourly finalisation, stream = batch."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from candela.operators.dedup import first_arrival_stream
from candela.streaming import runner as ST

CANDLE = ("symbol string, open_time_ts timestamp, ingestion_timestamp timestamp, source_system string, "
          "is_final boolean")


def _append(spark, rows, schema, path):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)


def test_late_rows_dropped_by_watermark_kept_by_merge(spark, tmp_dir):
    inp, out, ck = f"{tmp_dir}/in", f"{tmp_dir}/out", f"{tmp_dir}/ck"
    t = dt.datetime
    ing = t(2024, 6, 2)
    trig1 = [("A", t(2024, 6, 1, 10, 0), ing, "s", True), ("A", t(2024, 6, 1, 10, 0), ing, "s", True),
             ("A", t(2020, 1, 1, 0, 0), ing, "s", True)]
    trig2 = [("A", t(2020, 1, 1, 0, 1), ing, "s", True), ("A", t(2024, 6, 1, 10, 1), ing, "s", True),
             ("A", t(2024, 6, 1, 10, 0), ing, "s", True)]
    schema = spark.createDataFrame(trig1, CANDLE).schema

    def once():
        ST.run(first_arrival_stream(spark.readStream.schema(schema).parquet(inp)), ck, sink_path=out)
    _append(spark, trig1, CANDLE, inp); once()
    assert spark.read.parquet(out).count() == 2
    _append(spark, trig2, CANDLE, inp); once()
    got = sorted(r.open_time_ts for r in spark.read.parquet(out).collect())
    assert got == [t(2020, 1, 1, 0, 0), t(2024, 6, 1, 10, 0), t(2024, 6, 1, 10, 1)]


FACT = ("symbol_id int, timestamp_key timestamp, open decimal(18,8), high decimal(18,8), low decimal(18,8), "
        "close decimal(18,8), volume decimal(18,8), quote_asset_volume decimal(18,8), number_of_trades int, "
        "taker_buy_base_vol decimal(18,8)")


def _f(ts, p):
    p = Decimal(p)
    return (1, ts, p, p, p, p, Decimal(1), p, 1, Decimal(0))


def test_hourly_final_emits_once_after_delay(spark, tmp_dir):
    inp, out, ck = f"{tmp_dir}/in", f"{tmp_dir}/out", f"{tmp_dir}/ck"
    t = lambda h, m, s=0: dt.datetime(2024, 1, 1, h, m, s)
    schema = spark.createDataFrame([_f(t(0, 0), 1)], FACT).schema

    def once():
        ST.run(ST.hourly_final(spark.readStream.schema(schema).parquet(inp)), ck, sink_path=out)

    def n_out():
        try:
            return spark.read.parquet(out).count()
        except Exception:  # noqa: BLE001 - no output files yet
            return 0
    _append(spark, [_f(t(0, 59), 2), _f(t(0, 1), 1)], FACT, inp); once()
    assert n_out() == 0
    _append(spark, [_f(t(1, 4, 59), 5), _f(t(0, 30), 3)], FACT, inp); once()
    assert n_out() == 0
    _append(spark, [_f(t(1, 5), 6)], FACT, inp); once()
    rows = spark.read.parquet(out).collect()
    assert len(rows) == 1
    r = rows[0]
    assert (r.hour_start, r.open, r.close, r.total_trades) == (t(0, 0), Decimal(1), Decimal(2), 3)


def test_silver_stream_equals_batch_upsert(spark, tmp_dir):
    from candela.operators.rules import KLINE_RULES
    from candela.operators.stage import stage
    from candela.operators.upsert import latest_per_key
    from candela.plans import adapter as A
    bronze = A.bronze_from_events(A.table(spark, "/root/testdata/sf0.001", "events"))
    bronze.write.parquet(f"{tmp_dir}/bronze")
    bronze = spark.read.parquet(f"{tmp_dir}/bronze")
    inp, clean, quar, ck = f"{tmp_dir}/in", f"{tmp_dir}/clean", f"{tmp_dir}/q", f"{tmp_dir}/ck"
    day = F.dayofmonth("ingestion_timestamp")
    for lo, hi in ((1, 10), (11, 20), (21, 32)):
        bronze.filter(day.between(lo, hi)).write.mode("append").parquet(inp)
        src = stage(spark.readStream.schema(bronze.schema).parquet(inp))
        ST.run(src, ck, foreach_batch=ST.silver_batch_writer(clean, quar))
    staged = stage(bronze)
    want = latest_per_key(KLINE_RULES.valid(staged))
    got = spark.read.parquet(clean).drop(ST.DATE_COL)
    cols = ["symbol", "open_time_ts", "close", "ingestion_timestamp", "is_final"]
    assert sorted(got.select(cols).collect()) == sorted(want.select(cols).collect())
    # quarantine: every failing row once, whatever the batch split
    assert spark.read.parquet(quar).count() == KLINE_RULES.quarantine(staged).count()
    # replaying the last batch is a no-op for the clean table
    before = sorted(got.select(cols).collect())
    ST.silver_batch_writer(clean, quar)(staged.filter(day.between(21, 32)), 2)
    assert sorted(spark.read.parquet(clean).drop(ST.DATE_COL).select(cols).collect()) == before


def test_fact_merge_keeps_history_loaded_after_live(spark, tmp_dir):
    """The backfill route: the same merge writer, fed in batch, keeps rows a watermark would drop."""
    from tests.test_stage_rules import bronze_rows
    from candela.operators.stage import stage
    from candela.operators.rules import KLINE_RULES
    dim = spark.createDataFrame([("A", 1)], "symbol string, symbol_id int")
    ms = lambda d: int((d - dt.datetime(1970, 1, 1)).total_seconds() * 1000)
    t = dt.datetime

    def batch(rows):
        b = bronze_rows(spark, [{"name": n, "open_time": ms(ts), "close_time": ms(ts) + 59999} for n, ts in rows])
        return KLINE_RULES.valid(stage(b)).withColumns({
            "ingestion_timestamp": F.lit("2024-06-02 00:00:00").cast("timestamp"), "source_system": F.lit("s")})
    write = ST.fact_batch_writer(f"{tmp_dir}/fact", dim)
    write(batch([("a", t(2024, 6, 1, 10, 0)), ("b", t(2024, 6, 1, 10, 0)), ("c", t(2020, 1, 1, 0, 0))]), 0)
    write(batch([("d", t(2020, 1, 1, 0, 1)), ("e", t(2024, 6, 1, 10, 1)), ("f", t(2024, 6, 1, 10, 0))]), 1)
    write(batch([("d", t(2020, 1, 1, 0, 1))]), 1)  # replayed batch
    got = sorted(r.timestamp_key for r in spark.read.parquet(f"{tmp_dir}/fact").collect())
    assert got == [t(2020, 1, 1, 0, 0), t(2020, 1, 1, 0, 1), t(2024, 6, 1, 10, 0), t(2024, 6, 1, 10, 1)]


def test_two_runs_with_one_batch_number_keep_all_dead_letters(spark, tmp_dir):
    from candela.operators.stage import stage
    from candela.plans.catalog import bronze_frame
    rows = stage(bronze_frame(spark, "/root/testdata/sf0.001"))
    bad = rows.withColumn("symbol", F.lit(None).cast("string"))
    for k in (0, 1):
        ST.silver_batch_writer(f"{tmp_dir}/clean{k}", f"{tmp_dir}/quarantine")(bad.filter(F.pmod(F.hash("open_time"), F.lit(2)) == k), 0)
    assert spark.read.parquet(f"{tmp_dir}/quarantine").count() == bad.count()


def test_merge_stopped_between_removal_and_new_files_loses_nothing(spark, tmp_dir):
    """The copy is finished, the old partitions are gone, the new files are not there: the replay carries it through."""
    from candela.session import remove
    target, schema = f"{tmp_dir}/t", "symbol string, at timestamp, v int"
    t = dt.datetime
    rows = [("A", t(2024, 6, 1, 10, k % 60), k) for k in range(50)] + [("B", t(2024, 6, 2), 7)]
    first = lambda df: df.dropDuplicates(["symbol", "at"])
    merge = lambda rs: ST.merge_into_dates(spark.createDataFrame(rs, schema), target, F.to_date("at"), ["symbol", "at"], first)
    assert len(merge(rows)) == 2
    whole = sorted(spark.read.parquet(target).collect())
    for moved in ([], ["2024-06-02"]):     # stopped at the first date, or when another one had moved
        spark.read.parquet(target).write.partitionBy(ST.DATE_COL).parquet(f"{target}/_merge/rows")   # as a finished copy would be
        for day in moved:
            remove(spark, f"{target}/_merge/rows/{ST.DATE_COL}={day}")
        remove(spark, f"{target}/{ST.DATE_COL}=2024-06-01")
        assert spark.read.parquet(target).count() == 1
        merge(rows[:3])
        assert sorted(spark.read.parquet(target).collect()) == whole
    # an unfinished copy is dropped
    spark.createDataFrame(rows[:1], schema).write.parquet(f"{target}/_merge/rows")
    remove(spark, f"{target}/_merge/rows/_SUCCESS")
    merge(rows[3:4])
    assert sorted(spark.read.parquet(target).collect()) == whole


def test_symbol_added_between_fact_batches_loses_no_row(spark, tmp_dir):
    from candela import schemas as S
    from candela.operators.dims import register_symbols
    from candela.operators.rules import KLINE_RULES
    from candela.operators.stage import stage
    from tests.test_stage_rules import bronze_rows
    records = lambda names: spark.createDataFrame([(n, "TRADING", n, 8, "USDT", 8, "2020-01-01 00:00:00") for n in names], S.SYMBOL_RECORD)
    ms = int((dt.datetime(2024, 6, 1) - dt.datetime(1970, 1, 1)).total_seconds() * 1000)

    def batch(names):
        b = bronze_rows(spark, [{"name": "x", "open_time": ms, "close_time": ms + 59999, "symbol": n} for n in names])
        return KLINE_RULES.valid(stage(b)).withColumns({"ingestion_timestamp": F.lit("2024-06-02").cast("timestamp"), "source_system": F.lit("s")})
    reg, fact, hourly = f"{tmp_dir}/ids", f"{tmp_dir}/fact", f"{tmp_dir}/hourly"
    ST.fact_batch_writer(fact, register_symbols(reg, records(["B", "C"])), hourly)(batch(["B", "C"]), 0)
    dim = register_symbols(reg, records(["A", "B", "C"]))
    assert {r.symbol: r.symbol_id for r in dim.collect()} == {"B": 1, "C": 2, "A": 3}
    ST.fact_batch_writer(fact, dim, hourly)(batch(["A", "B"]), 1)
    assert sorted(r.symbol_id for r in spark.read.parquet(fact).collect()) == [1, 2, 3]
    assert spark.read.parquet(hourly).count() == 3  # the late symbol's hour is there too
