"""Date and time expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_datetime(c: Column) -> Column:
    """Lenient parse to a zone-less timestamp; bad text becomes NULL."""
    return c.try_cast("timestamp_ntz")


def month_start(c: Column) -> Column:
    """First instant of the month, without a zone."""
    return F.date_trunc("month", c).cast("timestamp_ntz")


def month_label(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM")


def iso_week(c: Column) -> Column:
    return F.weekofyear(c)


def iso_year(c: Column) -> Column:
    """Year the ISO week belongs to: the year of that week's Thursday."""
    return F.year(F.date_add(F.date_trunc("week", c).cast("date"), 3))
