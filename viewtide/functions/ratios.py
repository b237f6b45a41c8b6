"""Quotients that are null, not an error, when the divisor is zero."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def ratio(numerator: Column, denominator: Column) -> Column:
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def int_ratio(numerator: Column, denominator: Column) -> Column:
    """The quotient cut to a whole number, towards zero."""
    return ratio(numerator, denominator).cast("long")
