"""Exact sums of amounts with two decimals.

Sums run over whole cents in 64-bit integers: exact in any order, and several times
faster than wide decimals. Overflow raises, it never wraps.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from feira.schemas import AMOUNT, MEASURED, TOTAL


def cents(c: Column) -> Column:
    """Whole cents of a decimal, or of a double that holds a two-decimal amount."""
    return F.round(c * 100).cast("bigint")


def amount(cents_: Column) -> Column:
    """Cents back to a decimal amount."""
    return (cents_.cast("decimal(18,0)") * F.lit(Decimal("0.01"))).cast(TOTAL)


def line_amount(cents_: Column) -> Column:
    """As amount, for single lines: within 18 digits, so decimals stay plain longs."""
    return (cents_.cast("decimal(14,0)") * F.lit(Decimal("0.01"))).cast(AMOUNT)


def total(c: Column) -> Column:
    """Exact sum of an amount column."""
    return amount(F.sum(cents(c)))


def measured(c: Column) -> Column:
    """A measured value, which may have more than two decimals, as a decimal that sums
    exactly in any order. Only totals are rounded."""
    return c.cast(MEASURED)
