"""Arithmetic with the floating-point rules the streaming results follow."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ieee_div(numerator: Column, denominator: Column, null_on_zero: bool = False) -> Column:
    """Double division where x/0 is an infinity and 0/0 is NaN.

    ANSI Spark raises on a zero divisor. ``null_on_zero`` gives NULL instead.
    """
    quotient = F.try_divide(numerator, denominator)
    if null_on_zero:
        return quotient
    by_zero = (
        F.when(F.isnan(numerator) | (numerator == 0), F.lit(float("nan")))
        .when(numerator > 0, F.lit(float("inf")))
        .when(numerator < 0, F.lit(float("-inf")))
    )
    return F.when(denominator == 0, by_zero).otherwise(quotient)


def guarded_ratio(numerator: Column, denominator: Column) -> Column:
    """NULL where the divisor is zero, the quotient elsewhere."""
    return F.when(denominator != 0, F.try_divide(numerator, denominator))
