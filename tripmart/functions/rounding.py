"""Two-decimal rounding that gives the same answer in every engine.

Rounding a quotient of doubles depends on how the engine treats a tie (``1.005`` is stored just below
the tie). Averages and ratios are therefore rounded half-up in integers, and only the finished number
of hundredths becomes a double. Inputs are non-negative.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_2dp(c: Column) -> Column:
    """Round a double half-up to two decimals without going through BigDecimal."""
    return F.floor(c * 100.0 + 0.5) / F.lit(100.0)


def hundredths(c: Column) -> Column:
    """A column that already has two decimals, as an exact whole number of hundredths."""
    return F.floor(c * 100.0 + 0.5)


def _div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def mean_2dp(total_hundredths: Column, n: Column) -> Column:
    """Mean of ``n`` two-decimal values given the sum of their hundredths; NULL when ``n`` is 0."""
    n = F.nullif(n, F.lit(0).cast("bigint"))
    return _div(total_hundredths * 2 + n, n * 2) / F.lit(100.0)


def ratio_2dp(a: Column, b: Column, scale: int = 1) -> Column:
    """``scale * a / b`` for counts, rounded half-up to two decimals; NULL when ``b`` is 0."""
    b = F.nullif(b, F.lit(0).cast("bigint"))
    return _div(a * (200 * scale) + b, b * 2) / F.lit(100.0)
