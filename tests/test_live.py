"""End to end: landed archive CSVs -> scheduled refreshes -> clean, quarantine, fact, hourly."""

import os

from pyspark.sql import functions as F

from candela import schemas as S
from candela.operators.rules import KLINE_RULES
from candela.operators.stage import stage
from candela.streaming.live import refresh


def _land(path, lines):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write("\n".join(lines) + "\n")


def _line(minute, close, trades=1):
    t = 1704067200000 + minute * 60000
    return f"{t},1.0,5.0,0.5,{close},10,{t + 59999},15,{trades},4,6,0"


def test_scheduled_refreshes(spark, tmp_dir):
    csv = f"{tmp_dir}/landing"
    dim = spark.createDataFrame([("AAA", "TRADING", "A", 8, "USDT", 8, None)], S.SYMBOL_RECORD)
    _land(f"{csv}/symbol=AAA/year=2024/month=01.csv", [_line(m, 2.0) for m in range(0, 50)] + [_line(3, -1.0)])
    p = refresh(spark, csv, f"{tmp_dir}/lake", dim)
    assert spark.read.parquet(p.clean).count() == 50
    assert spark.read.parquet(p.quarantine).count() == 1
    assert spark.read.parquet(p.fact).count() == 50
    # next landing: the rest of hour 0 and all of hour 1, plus minutes into hour 2
    _land(f"{csv}/symbol=AAA/year=2024/month=01b.csv", [_line(m, 3.0) for m in range(50, 136)])
    refresh(spark, csv, f"{tmp_dir}/lake", dim)
    assert spark.read.parquet(p.clean).count() == 136
    assert spark.read.parquet(p.fact).count() == 136
    hourly = spark.read.parquet(p.hourly).orderBy("hour_start").collect()
    # hours 0 and 1 are final (max event 02:15 - 10 min >= 02:00); hour 2 is still open
    assert [r.total_trades for r in hourly] == [60, 60]
    assert [str(r.close) for r in hourly] == ["3.00000000", "3.00000000"]
    bronze = spark.read.parquet(p.bronze)
    assert bronze.count() == 137
    assert KLINE_RULES.quarantine(stage(bronze)).count() == 1
    assert spark.read.parquet(p.fact).filter(F.col("symbol_id").isNull()).count() == 0


def test_continuous_trigger_and_broker_options(spark, tmp_dir):
    from candela.sources.messages import broker_options
    from candela.streaming.live import Paths, run_bronze
    opts = broker_options("host:9093", "candles")
    assert opts["maxOffsetsPerTrigger"] == "10000" and opts["failOnDataLoss"] == "false"
    assert opts["startingOffsets"] == "latest" and opts["subscribe"] == "candles"
    csv = f"{tmp_dir}/landing"
    _land(f"{csv}/symbol=AAA/year=2024/month=01.csv", [_line(m, 2.0) for m in range(10)])
    p = Paths(f"{tmp_dir}/lake")
    q = run_bronze(spark, csv, p, available_now=False, processing_time="1 second")
    try:
        q.processAllAvailable()
        _land(f"{csv}/symbol=BBB/year=2024/month=01.csv", [_line(m, 2.0) for m in range(5)])
        q.processAllAvailable()
    finally:
        q.stop()
    got = {r.symbol: r["count"] for r in spark.read.parquet(p.bronze).groupBy("symbol").count().collect()}
    assert got == {"AAA": 10, "BBB": 5}
