"""Column expressions shared by the operators. All are built-in Spark functions (codegen, no Python)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from candela import schemas as S


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_price(c) -> Column:
    """Decimal text -> decimal(18,8). Unreadable or too-large text gives NULL instead of failing the job."""
    return _c(c).try_cast(S.PRICE)


def epoch_to_timestamp(c) -> Column:
    """Epoch number -> timestamp: microseconds above the fixed threshold, milliseconds otherwise.

    Integer conversions (no floating division), so sub-millisecond parts are exact.
    """
    c = _c(c)
    return (F.when(c > F.lit(S.EPOCH_MICROS_ABOVE), F.timestamp_micros(c))
             .otherwise(F.timestamp_millis(c)))


def null_if_zero(c) -> Column:
    c = _c(c)
    return F.when(c == 0, F.lit(None)).otherwise(c)


def ratio(num, den) -> Column:
    """num / den, NULL when den is 0 (or NULL)."""
    return _c(num) / null_if_zero(den)


def minute_index(ts) -> Column:
    """Whole minutes since the epoch."""
    return F.floor(F.unix_seconds(_c(ts)) / 60).cast("long")


def trading_session(ts) -> Column:
    h = F.hour(_c(ts))
    expr = None
    for name, lo, hi in S.SESSIONS:
        expr = (F.when(h.between(lo, hi), F.lit(name)) if expr is None
                else expr.when(h.between(lo, hi), F.lit(name)))
    return expr.otherwise(F.lit(S.SESSION_OTHER))


def time_part_map(ts) -> dict[str, Column]:
    """Calendar attributes of a minute timestamp, by name, in dimension-table order."""
    ts = _c(ts)
    parts = {
        "year": F.year(ts),
        "month": F.month(ts),
        "day": F.dayofmonth(ts),
        "hour": F.hour(ts),
        "minute": F.minute(ts),
        "quarter": F.quarter(ts),
        "day_name": F.date_format(ts, "EEEE"),
        "day_name_short": F.date_format(ts, "EEE"),
        "day_of_week": F.dayofweek(ts),
        "is_weekend": F.dayofweek(ts).isin(*S.WEEKEND_DAYS),
        "trading_session": trading_session(ts),
        "date": F.to_date(ts),
    }
    return {k: v.alias(k) for k, v in parts.items()}


def time_parts(ts) -> list[Column]:
    return list(time_part_map(ts).values())
