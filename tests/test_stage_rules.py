"""Staging casts, epoch units, derived ratios and NULL-safe routing (edge rows of FIXTURES.md)."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from candela import schemas as S
from candela.operators.rules import KLINE_RULES, failure_summary
from candela.operators.stage import stage

MS_2024 = 1704067200000  # 2024-01-01 00:00:00 UTC in ms
MS_FLOOR = 1501545600000  # 2017-08-01 00:00:00 UTC in ms


def bronze_rows(spark, rows):
    cols = ["name", "symbol", "open_time", "close_time", "open", "high", "low", "close", "volume",
            "number_of_trades", "quote_asset_volume", "taker_buy_base_vol", "taker_buy_quote_vol", "is_final"]
    schema = ("name string, symbol string, open_time long, close_time long, open string, high string, low string, "
              "close string, volume string, number_of_trades int, quote_asset_volume string, "
              "taker_buy_base_vol string, taker_buy_quote_vol string, is_final boolean")
    base = dict(name="ok", symbol="A", open_time=MS_2024, close_time=MS_2024 + 59999, open="1", high="2", low="1",
                close="1", volume="10", number_of_trades=3, quote_asset_volume="10", taker_buy_base_vol="4",
                taker_buy_quote_vol="4", is_final=True)
    data = []
    for r in rows:
        d = dict(base)
        d.update(r)
        data.append(tuple(d[c] for c in cols))
    return spark.createDataFrame(data, schema)


EDGE = [
    ({"name": "ok"}, None, ""),
    ({"name": "neg", "close": "-1"}, "valid_price", "valid_price"),
    ({"name": "old", "open_time": MS_FLOOR}, "valid_timestamp", "valid_timestamp"),
    ({"name": "nullts", "open_time": None}, "valid_timestamp", "valid_timestamp"),
    ({"name": "nullsym", "symbol": None}, "valid_symbol", "valid_symbol"),
    ({"name": "neg_nullsym", "close": "-1", "symbol": None}, "valid_price", "valid_price,valid_symbol"),
    ({"name": "allnull", **{k: None for k in ["symbol", "open_time", "close_time", "open", "high", "low", "close",
                                              "volume", "number_of_trades", "quote_asset_volume",
                                              "taker_buy_base_vol", "taker_buy_quote_vol", "is_final"]}},
     "valid_price", "valid_price,valid_timestamp,valid_symbol"),
    ({"name": "nullclose", "close": None}, "valid_price", "valid_price"),
    ({"name": "nullhigh", "high": None}, "valid_price", "valid_price"),
]


def test_edge_rows_route_exactly_once(spark):
    staged = stage(bronze_rows(spark, [r for r, _, _ in EDGE]))
    valid = {r.name for r in KLINE_RULES.valid(staged).collect()}
    q = {r.name: (r.failed_rule, ",".join(r.failed_rules)) for r in KLINE_RULES.quarantine(staged).collect()}
    assert valid == {"ok"}
    for row, rule, rules in EDGE:
        if rule is None:
            assert row["name"] not in q
        else:
            assert q[row["name"]] == (rule, rules), row["name"]
    # nothing lost, nothing doubled
    assert len(valid) + len(q) == len(EDGE)


def test_failure_summary(spark):
    staged = stage(bronze_rows(spark, [r for r, _, _ in EDGE]))
    got = {r.failed_rule: r.n_rows for r in failure_summary(KLINE_RULES.quarantine(staged)).collect()}
    assert got == {"valid_price": 5, "valid_timestamp": 2, "valid_symbol": 1}


def test_price_casts(spark):
    texts = ["abc", "100000000000", "0.123456785", " 1.5 ", "1e3", ""]
    df = bronze_rows(spark, [{"name": t, "open": t} for t in texts])
    got = {r.name: r.open for r in stage(df).collect()}
    assert got["abc"] is None and got["100000000000"] is None and got[""] is None
    assert got["0.123456785"] == Decimal("0.12345679")
    assert got[" 1.5 "] == Decimal("1.50000000")
    assert got["1e3"] == Decimal("1000.00000000")
    assert stage(df).schema["open"].dataType == S.PRICE


def test_epoch_units(spark):
    us = MS_2024 * 1000 + 123456
    df = bronze_rows(spark, [{"name": "ms", "open_time": MS_2024 + 7}, {"name": "us", "open_time": us}])
    got = {r.name: r.open_time_ts for r in stage(df).collect()}
    assert got["ms"] == dt.datetime(2024, 1, 1, 0, 0, 0, 7000)
    assert got["us"] == dt.datetime(2024, 1, 1, 0, 0, 0, 123456)


def test_ratios_null_on_zero(spark):
    df = bronze_rows(spark, [{"name": "v0", "volume": "0"}, {"name": "o0", "open": "0"},
                             {"name": "ok", "open": "2", "close": "3", "volume": "8", "taker_buy_base_vol": "2"}])
    got = {r.name: r for r in stage(df).collect()}
    assert got["v0"].buy_sell_ratio is None
    assert got["o0"].price_change_pct is None
    assert got["ok"].price_change_pct == Decimal("50")
    assert got["ok"].buy_sell_ratio == Decimal("0.25")
    assert got["ok"].price_range == Decimal("1") and got["ok"].price_change == Decimal("1")


def test_rules_are_data(spark):
    from candela.operators.rules import STRICT_KLINE_RULES as rules
    staged = stage(bronze_rows(spark, [{"name": "nullopen", "open": None}, {"name": "ok"}]))
    assert {r.name for r in KLINE_RULES.valid(staged).collect()} == {"nullopen", "ok"}
    assert {r.name for r in rules.valid(staged).collect()} == {"ok"}
    assert staged.filter(F.col("name") == "nullopen").select(rules.first_failed()).first()[0] == "complete_measures"
