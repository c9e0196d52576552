"""Guarded arithmetic. ANSI mode raises on x/0, the reports want null or 0 there."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(num: Column, den: Column, scale: int = 2) -> Column:
    """num/den in exact decimal arithmetic, half-up to ``scale`` digits; null when den is 0."""
    quotient = F.try_divide(num.cast("decimal(24,4)"), den.cast("decimal(24,4)"))
    return quotient.cast(f"decimal(16,{scale})")


def mean(total: Column, n: Column) -> Column:
    """Double mean from an exact sum and a count; null when n is 0."""
    return F.try_divide(total.cast("double"), n.cast("double"))


def zero_guarded(num: Column, den: Column) -> Column:
    """num/den as double, 0 when den is 0."""
    return F.when(den == 0, F.lit(0.0)).otherwise(F.try_divide(num.cast("double"), den.cast("double")))


def no_negative(col: Column) -> Column:
    """Clamp below zero; null stays null (``greatest`` would hide it)."""
    return F.when(col < 0, F.lit(0).cast("int")).otherwise(col)


def or_zero(col: Column) -> Column:
    return F.coalesce(col, F.lit(0))


def count_if(cond: Column) -> Column:
    return F.count(F.when(cond, F.lit(1)))


def sum_if(cond: Column, value) -> Column:
    value = value if isinstance(value, Column) else F.lit(value)
    return F.sum(F.when(cond, value).otherwise(F.lit(0)))


def distinct_if(cond: Column, value: Column) -> Column:
    return F.count_distinct(F.when(cond, value))
