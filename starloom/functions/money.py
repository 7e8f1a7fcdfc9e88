"""Money arithmetic on decimals (exact, HALF_UP rounding)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(12,2)"
PCT = "decimal(5,2)"
SMALL_MONEY = "decimal(8,2)"
TOTAL = "decimal(18,2)"


def _as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money(c, dtype: str = MONEY) -> Column:
    return _as_col(c).cast(dtype)


def round_money(expr: Column, dtype: str = MONEY) -> Column:
    """Round to cents and cast to the declared column type."""
    return F.round(expr, 2).cast(dtype)


def dec(literal: str) -> Column:
    """A decimal literal with the precision of its text (e.g. '0.08')."""
    return F.expr(f"{literal}BD")
