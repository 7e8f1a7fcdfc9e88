"""Calendar expressions: integer date keys, fiscal periods, time differences."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from starloom.params import FISCAL_START_MONTH


def _as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def date_key(d) -> Column:
    """yyyymmdd as an integer."""
    d = _as_col(d)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def fiscal_year(d, start_month: int = FISCAL_START_MONTH) -> Column:
    """Fiscal year named after the calendar year it ends in.

    With ``start_month = 1`` the fiscal year is the calendar year.
    """
    d = _as_col(d)
    if start_month == 1:
        return F.year(d)
    return F.when(F.month(d) >= start_month, F.year(d) + 1).otherwise(F.year(d))


def fiscal_quarter(d, start_month: int = FISCAL_START_MONTH) -> Column:
    """1..4, quarter 1 starting at ``start_month``."""
    d = _as_col(d)
    return (F.floor(((F.month(d) - start_month + 12) % 12) / 3) + 1).cast("int")


def day_of_week(d) -> Column:
    """1 = Sunday .. 7 = Saturday."""
    return F.dayofweek(_as_col(d))


def is_weekend(d) -> Column:
    return F.dayofweek(_as_col(d)).isin(1, 7)


def calendar_days(start, end) -> Column:
    """Number of calendar-day boundaries from ``start`` to ``end``."""
    return F.datediff(F.to_date(_as_col(end)), F.to_date(_as_col(start)))


def whole_seconds(start, end) -> Column:
    """Second boundaries crossed from ``start`` to ``end`` (difference of
    whole-second epochs), the warehouse meaning of DATEDIFF('second', a, b)."""
    s = F.floor(F.unix_micros(_as_col(start).cast("timestamp")) / 1_000_000)
    e = F.floor(F.unix_micros(_as_col(end).cast("timestamp")) / 1_000_000)
    return (e - s).cast("long")


def month_start(d) -> Column:
    """First day of the month, still a DATE."""
    return F.trunc(_as_col(d), "month")
