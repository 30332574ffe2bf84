"""Exact money arithmetic over integer cents.

Sums of cents can pass the BIGINT range on very large tables, and a DECIMAL sum
costs about five times a BIGINT sum. ``money_sum`` therefore sums the high and
the low 20 bits apart as BIGINT (both stay in code generation and combine on the
map side) and joins them as DECIMAL once per group. Ratios are rounded half up
from integers, so the result never depends on summation order.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

_LOW_BITS = 20
_LOW_MASK = (1 << _LOW_BITS) - 1


def _column(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def floor_div(numerator: Column, denominator: Column) -> Column:
    """Integer division towards minus infinity by a positive number; null for a denominator of 0."""
    whole = F.nullif(denominator, F.lit(0))
    cut = F.call_function("div", numerator, whole)
    return F.when(numerator % whole < 0, cut - 1).otherwise(cut)


def money_sum(cents: Column | str) -> Column:
    """Exact sum of a BIGINT column as DECIMAL with scale 0."""
    cents = _column(cents).cast("bigint")
    high = F.sum(F.shiftright(cents, _LOW_BITS)).cast("decimal(20,0)")
    low = F.sum(cents.bitwiseAND(F.lit(_LOW_MASK))).cast("decimal(20,0)")
    return high * F.lit(1 << _LOW_BITS).cast("decimal(7,0)") + low


def units(cents: Column | str) -> Column:
    """Cents to currency units."""
    return _column(cents).cast("double") / F.lit(100.0)


def mean_cents(total: Column, count: Column) -> Column:
    """``total / count`` in whole cents, half up; null for an empty group."""
    return floor_div(F.lit(2) * total + count, F.lit(2) * count)


def mean2(total: Column, count: Column) -> Column:
    """Mean of cents as currency units with 2 decimals."""
    return units(mean_cents(total, count))


def ratio2(part: Column, whole: Column) -> Column:
    """``part / whole`` of two non-negative integers, 2 decimals half up."""
    return units(floor_div(F.lit(2) * part * F.lit(100) + whole, F.lit(2) * whole))


def percent2(part: Column, whole: Column) -> Column:
    """``100 * part / whole`` of two non-negative integers, 2 decimals half up."""
    return units(floor_div(F.lit(2) * part * F.lit(10000) + whole, F.lit(2) * whole))


def signed_percent2(delta: Column, base: Column) -> Column:
    """``percent2`` for a delta of either sign; half rounds away from zero."""
    size = floor_div(F.lit(2) * F.abs(delta) * F.lit(10000) + base, F.lit(2) * base)
    return units(F.when(delta < 0, -size).otherwise(size))


def safe_divide(a: Column, b: Column, alternate: float = 0.0) -> Column:
    """Division that yields ``alternate`` for a zero or blank denominator."""
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(alternate))
