"""Exact money arithmetic: DECIMAL sums do not depend on the order of the rows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(12,2)"
PERCENT = "decimal(5,2)"


def total(value: Column, scale: int = 2) -> Column:
    """Sum, rounded half away from zero."""
    return F.round(F.sum(value), scale)


def ratio(numerator: Column, denominator: Column, scale: int) -> Column:
    """numerator / denominator rounded to `scale`; NULL where the denominator is 0 or NULL.

    For sums with up to six decimals and whole denominators, any BIGINT; the quotient keeps 16 decimals,
    enough to round half-way cases right.
    """
    quotient = F.try_divide(numerator.cast("decimal(28,6)"), denominator.cast("decimal(20,0)"))
    return F.round(quotient, scale)


def money_ratio(numerator: Column, denominator: Column, scale: int) -> Column:
    """As `ratio`, for a money denominator with up to six decimals."""
    quotient = F.try_divide(numerator.cast("decimal(26,8)"), denominator.cast("decimal(22,6)"))
    return F.round(quotient, scale)


def average(value: Column, scale: int = 2) -> Column:
    """Mean of a money column from its exact sum."""
    return ratio(F.sum(value), F.count(value), scale)


def discounted(amount: Column, percent: Column) -> Column:
    """amount reduced by `percent` of a hundred."""
    return amount * ((F.lit(100).cast("decimal(3,0)") - percent) * F.lit("0.01").cast("decimal(3,2)"))


def percent_change(current: Column, previous: Column) -> Column:
    """Change in percent with two decimals; NULL on a zero base."""
    change = (current - previous) * 100 / F.when(previous != 0, previous)
    return F.round(change, 2)


def percent_change_text(current: Column, previous: Column) -> Column:
    """Change in percent as text, `n/a` on a zero base."""
    shown = F.concat(percent_change(current, previous).cast("string"), F.lit("%"))
    return F.when(previous == 0, F.lit("n/a")).otherwise(shown)
