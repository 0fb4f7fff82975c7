"""Exact decimal arithmetic for money.

Source amounts are cast to ``decimal(20,8)`` *before* any SUM so totals are exact
and independent of summation order. Percentages are ``decimal(9,4)``; a percent
is applied as ``x * pct * 0.01`` (no division, so no engine-specific scale).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import config as C



def zero() -> Column:
    return F.lit(0).cast(C.MONEY)


def one_percent() -> Column:
    return F.lit("0.01").cast("decimal(3,2)")


def money(c: Column | str) -> Column:
    return _col(c).cast(C.MONEY)


def sum_money(c: Column | str) -> Column:
    """``CAST(COALESCE(SUM(c), 0) AS decimal(20,8))`` with ``c`` made exact first."""
    return F.coalesce(F.sum(_col(c).cast(C.MONEY)), zero()).cast(C.MONEY)


def pct_of(amount: Column, pct: Column) -> Column:
    """``amount * pct / 100`` exactly (scale grows, nothing is rounded)."""
    return amount * F.coalesce(pct.cast(C.PERCENT), F.lit(0).cast(C.PERCENT)) * one_percent()


def after_discount(amount: Column, discount_pct: Column) -> Column:
    """``amount - amount * discount / 100`` rounded half-up to 8 places."""
    return (amount - pct_of(amount, discount_pct)).cast(C.MONEY)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c
