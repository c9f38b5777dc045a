"""Predicates of the row rules. All are NULL-safe: NULL and '' never pass."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The accepted e-mail shape and the two accepted date formats.
# (?U) makes \w match accented letters, which customer names carry.
EMAIL_PATTERN = r"(?U)^[\w.-]+@[\w.-]+\.\w+$"
DATE_FORMATS = {
    r"^\d{4}-\d{1,2}-\d{1,2}$": "yyyy-M-d",
    r"^\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{1,2}:\d{1,2}$": "yyyy-M-d H:m:s",
}

_INTEGER = r"^\s*[+-]?[0-9]+\s*$"
_NUMBER = (
    r"(?i)^\s*[+-]?(([0-9]+\.?[0-9]*|\.[0-9]+)(e[+-]?[0-9]+)?|inf|infinity|nan)\s*$"
)


def is_blank(c: Column) -> Column:
    return F.coalesce(c, F.lit("")) == ""


def is_valid_email(c: Column) -> Column:
    return F.coalesce(c.rlike(EMAIL_PATTERN), F.lit(False))


def has_at_sign(c: Column) -> Column:
    return F.coalesce(F.contains(c, F.lit("@")), F.lit(False))


def is_valid_date(c: Column) -> Column:
    # The shape picks the one format to parse with: a failed parse is slow.
    parsed = F.coalesce(
        *[F.when(c.rlike(s), F.try_to_timestamp(c, F.lit(f))) for s, f in DATE_FORMATS.items()]
    )
    return parsed.isNotNull()


def parse_integer(c: Column) -> Column:
    """Whole numbers of any width; '3.0' is not one."""
    return F.when(c.rlike(_INTEGER), F.trim(c).try_cast("decimal(38,0)"))


def parse_number(c: Column) -> Column:
    """Decimal text, including nan and inf; anything else is NULL."""
    return F.when(c.rlike(_NUMBER), F.trim(c).try_cast("double"))
