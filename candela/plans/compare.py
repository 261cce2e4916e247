"""Output normalisation for the oracle comparison (applied to query results only, not inside operators).

* ratio decimals (Spark's exact division, scales 10-20) -> rounded to 6 places -> double;
* timestamps (UTC instants) -> timestamp without zone, which is what the SQL side produces;
* arrays -> comma-joined text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, TimestampType

RATIO_COLUMNS = {"price_change_pct", "buy_sell_ratio", "vwap", "amplitude_pct", "buy_pressure_ratio",
                 "daily_change_pct", "buy_sell_imbalance", "avg_buy_pressure"}


def comparable(df: DataFrame, drop: tuple = (), ratios: set = RATIO_COLUMNS) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        if f.name in drop:
            continue
        c = F.col(f"`{f.name}`")
        if f.name in ratios:
            c = F.round(c, 6).cast("double")
        elif isinstance(f.dataType, TimestampType):
            c = c.cast("timestamp_ntz")
        elif isinstance(f.dataType, ArrayType):
            c = F.array_join(c, ",")
        cols.append(c.alias(f.name))
    return df.select(*cols)
