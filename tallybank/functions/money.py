"""Exact money sums that do not depend on row order.

Amounts are doubles. They are summed as whole cents in two 64-bit parts, which stay in generated code and
cannot overflow below nine trillion rows per group; the parts meet in a decimal. An amount with more than two
decimals is rounded as `decimal(18,2)` rounds it. One that is no finite number, or of 90 trillion or more, is
unfit: sums, averages and counts leave it out like a missing one.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PART = 1_000_000
CENTS = 100
LARGEST = 9e13


def _column(column: str | Column) -> Column:
    return F.col(column) if isinstance(column, str) else column


def is_fit(column: str | Column) -> Column:
    """Whether an amount can be summed. NaN is greater than any number here."""
    return F.abs(_column(column)) < LARGEST


def cents(column: str | Column) -> Column:
    """Whole cents of an amount; NULL if it is unfit.

    Two decimals are within a hundredth of a cent of a whole number; only others go through a decimal.
    """
    scaled = _column(column) * CENTS
    near = F.rint(scaled)
    rounded = (_column(column).cast("decimal(18,2)") * CENTS).cast("bigint")
    return F.when(is_fit(column), F.when(F.abs(scaled - near) < 0.01, near.cast("bigint")).otherwise(rounded))


def fit_count(column: str | Column) -> Column:
    """Number of amounts that can be summed."""
    return F.count_if(is_fit(column))


def exact_sum(column: str | Column, window=None) -> Column:
    """Total cents as decimal, of a group or over a window; such totals can be summed again."""
    whole = cents(column)
    # The quotient is exact for amounts below 90 trillion; the remainder has the sign of the amount.
    rest = whole % PART
    sums = [F.sum(((whole - rest) / PART).cast("bigint")), F.sum(rest)]
    high, low = sums if window is None else [part.over(window) for part in sums]
    return high.cast("decimal(20,0)") * F.lit(PART) + low.cast("decimal(20,0)")


def in_currency(total: str | Column) -> Column:
    """Total cents as a double amount."""
    total = F.col(total) if isinstance(total, str) else total
    return total.cast("double") / CENTS


def money_sum(column: str | Column) -> Column:
    """Exact sum of amounts, as double."""
    return in_currency(exact_sum(column))


def mean(total: str, count: str) -> Column:
    """Total cents over count, as a double amount; NULL when nothing was counted."""
    return F.when(F.col(count) > 0, in_currency(total) / F.col(count))
