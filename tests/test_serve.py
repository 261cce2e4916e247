"""Dashboard queries on hand-made daily / minute rows."""

import datetime as dt
from decimal import Decimal as D

from candela.operators import serve as V

DAILY = ("symbol_id int, date date, open decimal(18,8), high decimal(18,8), low decimal(18,8), "
         "close decimal(18,8), amplitude_pct decimal(38,19)")


def test_daily_change_and_rank(spark):
    d1, d2, d3 = dt.date(2024, 1, 1), dt.date(2024, 1, 2), dt.date(2024, 1, 3)
    rows = [(1, d1, D(1), D(2), D(1), D(0), D("0.5")), (1, d2, D(1), D(2), D(1), D(4), D("0.5")),
            (1, d3, D(1), D(2), D(1), D(5), None), (2, d1, D(1), D(2), D(1), D(2), D("0.7")),
            (2, d2, D(1), D(2), D(1), D(3), D("0.5"))]
    daily = spark.createDataFrame(rows, DAILY)
    pa = {(r.symbol_id, r.date): r.daily_change_pct for r in V.daily_price_action(daily).collect()}
    assert pa[(1, d1)] is None and pa[(1, d2)] is None          # no previous day / previous close 0
    assert pa[(1, d3)] == D(25) and pa[(2, d2)] == D(50)
    rk = {(r.symbol_id, r.date): r.volatility_rank for r in V.volatility_rank(daily).collect()}
    assert rk[(2, d1)] == 1 and rk[(1, d1)] == 2
    assert rk[(1, d2)] == rk[(2, d2)] == 1                      # ties share a rank
    assert rk[(1, d3)] == 1                                     # alone (NULL amplitude sorts last)


FACT = ("symbol_id int, timestamp_key timestamp, volume decimal(18,8), quote_asset_volume decimal(18,8), "
        "number_of_trades int, taker_buy_base_vol decimal(18,8)")


def test_sentiment_volume_and_sessions(spark):
    t = dt.datetime
    rows = [(1, t(2024, 1, 6, 3, 0), D(10), D(20), 2, D(7)),     # Saturday, Asia
            (1, t(2024, 1, 6, 3, 1), D(10), D(40), 3, D(3)),
            (1, t(2024, 1, 8, 9, 0), D(0), D(0), 1, D(0)),       # Monday, Europe, zero volume
            (1, t(2024, 1, 8, 20, 0), D(5), D(5), 1, D(5))]      # Monday, US
    fact = spark.createDataFrame(rows, FACT)
    s = {r.hour_start: r for r in V.market_sentiment(fact).collect()}
    h = s[t(2024, 1, 6, 3, 0)]
    assert h.buy_pressure_ratio == D("0.5") and h.buy_sell_imbalance == D(0)
    assert s[t(2024, 1, 8, 9, 0)].buy_sell_imbalance is None
    assert s[t(2024, 1, 8, 20, 0)].buy_sell_imbalance == D(1)
    va = {r.date: r for r in V.volume_analysis(fact).collect()}
    assert va[dt.date(2024, 1, 6)].vwap == D(3) and va[dt.date(2024, 1, 6)].taker_buy_volume == D(10)
    sb = {(r.trading_session, r.is_weekend): (r.n_minutes, r.total_trades) for r in V.session_breakdown(fact).collect()}
    assert sb == {("Asia", True): (2, 5), ("Europe", False): (1, 1), ("US", False): (1, 1)}
