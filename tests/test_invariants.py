"""Pipeline invariants on the driver tables (sf0.001)."""

from pyspark.sql import functions as F

from candela.operators import gaps as G
from candela.operators.rollup import daily_summary, hourly_summary
from candela.operators.rules import KLINE_RULES
from candela.operators.upsert import latest_per_key
from candela.plans import catalog as C

SF = "/root/testdata/sf0.001"


def test_volumes_add_up_across_grains(spark):
    fact = C.fact_frame(spark, SF)
    f = fact.agg(F.sum("volume")).first()[0]
    h = hourly_summary(fact).agg(F.sum("total_base_volume")).first()[0]
    d = daily_summary(fact).agg(F.sum("total_base_volume")).first()[0]
    assert f == h == d and f > 0


def test_ohlc_ordering(spark):
    fact = C.fact_frame(spark, SF)
    bad = fact.filter((F.col("low") > F.col("open")) | (F.col("low") > F.col("close")) |
                      (F.col("high") < F.col("open")) | (F.col("high") < F.col("close")))
    assert bad.count() == 0
    hb = hourly_summary(fact).filter((F.col("low") > F.col("open")) | (F.col("high") < F.col("close")))
    assert hb.count() == 0


def test_routes_partition_the_input_and_keys_are_unique(spark):
    staged = C.staged_frame(spark, SF)
    assert KLINE_RULES.valid(staged).count() + KLINE_RULES.quarantine(staged).count() == staged.count()
    clean = latest_per_key(KLINE_RULES.valid(staged))
    assert clean.count() == clean.select("symbol", "open_time_ts").distinct().count()
    fact = C.fact_frame(spark, SF)
    assert fact.count() == fact.select("symbol_id", "timestamp_key").distinct().count()


def test_gaps_and_present_cover_the_matrix(spark):
    fact, dim = C.fact_frame(spark, SF), C.dim_frame(spark, SF)
    as_of = C.as_of(spark, SF)
    start, end = G.window_bounds(as_of)
    missing = G.gap_report(fact, dim, as_of).count()
    present = G.present_minutes(fact, start, end).count()
    minutes = int((end - start).total_seconds() // 60)
    assert missing + present == dim.count() * minutes
