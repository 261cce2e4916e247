"""Silver staging: exact decimals, epoch normalisation and per-candle derived measures."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candela import schemas as S
from candela.functions.columns import epoch_to_timestamp, to_price


def stage(bronze: DataFrame) -> DataFrame:
    """Type and enrich bronze rows.

    * the eight price/volume texts become decimal(18,8); text that does not parse, or does not
      fit, becomes NULL (the quarantine rules then see it) instead of failing the whole job;
    * open/close epochs (ms, or µs above the fixed threshold) become timestamps;
    * price_range, price_change, price_change_pct (x100, NULL when open is 0) and
      buy_sell_ratio (taker buy base / volume, NULL unless volume > 0).

    Narrow projection only: no shuffle, stays inside one codegen stage.
    """
    typed = bronze.withColumns({c: to_price(c) for c in S.PRICE_COLUMNS if c in bronze.columns})
    typed = typed.withColumns({
        "open_time_ts": epoch_to_timestamp("open_time"),
        "close_time_ts": epoch_to_timestamp("close_time"),
    })
    o, h, l, c = F.col("open"), F.col("high"), F.col("low"), F.col("close")
    return typed.withColumns({
        "price_range": h - l,
        "price_change": c - o,
        "price_change_pct": F.when(o != 0, (c - o) / o * 100),
        "buy_sell_ratio": F.when(F.col("volume") > 0, F.col("taker_buy_base_vol") / F.col("volume")),
    })
