from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from feira.functions import calendar, validation
from feira.functions.money import amount, cents


def evaluate(spark, values, expression, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r[0] for r in df.select("i", expression(F.col("x")).alias("y")).orderBy("i").select("y").collect()]


def test_email(spark):
    good = ["alice@example.com", "first.last@sub.domain.pt", "joão.gonçalves.1@exemplo.pt", "a-b@c-d.e_f"]
    bad = ["not-an-email", "user@localhost", "", None, "two@@at.pt", "blank in@x.pt", "a@b.pt "]
    assert evaluate(spark, good + bad, validation.is_valid_email) == [True] * len(good) + [False] * len(bad)


def test_date(spark):
    good = ["2025-10-26", "2025-10-26 19:30:45", "2025-1-5", "2025-1-5 7:05:09"]
    bad = ["26/10/2025", "2025-13-40", "2025-02-30", "", None, "25-1-5", "2025-10-26 25:00:00", "2025-10-26 19:30"]
    assert evaluate(spark, good + bad, validation.is_valid_date) == [True] * len(good) + [False] * len(bad)


def test_numbers(spark):
    assert evaluate(spark, ["3", " 3 ", "+4", "-1", "99999999999", "3.0", "x", "", None], lambda c: validation.parse_integer(c).cast("long")) == [
        3, 3, 4, -1, 99999999999, None, None, None, None,
    ]
    got = evaluate(spark, ["1.5", " 2 ", "1e3", "inf", "-Infinity", ".5", "5.", "1.0d", "x", "", None], validation.parse_number)
    assert got == [1.5, 2.0, 1000.0, float("inf"), float("-inf"), 0.5, 5.0, None, None, None, None]
    assert evaluate(spark, ["nan"], lambda c: F.isnan(validation.parse_number(c))) == [True]


def test_at_sign(spark):
    assert evaluate(spark, ["a@b", "ab", None], validation.has_at_sign) == [True, False, False]


def test_calendar(spark):
    days = [date(2020, 12, 31), date(2021, 1, 3), date(2021, 1, 4), None]
    assert evaluate(spark, days, calendar.iso_week, "date") == [53, 53, 1, None]
    assert evaluate(spark, days, calendar.iso_year, "date") == [2020, 2020, 2021, None]
    assert evaluate(spark, days, calendar.month_label, "date") == ["2020-12", "2021-01", "2021-01", None]
    parsed = evaluate(spark, ["2025-10-01 10:00:00", "2025-10-01", "soon", None], calendar.parse_datetime)
    assert parsed == [datetime(2025, 10, 1, 10), datetime(2025, 10, 1), None, None]
    assert evaluate(spark, [datetime(2025, 10, 26, 3)], calendar.month_start, "timestamp_ntz") == [datetime(2025, 10, 1)]


@pytest.mark.parametrize("kind", ["double", "decimal(14,2)"])
def test_cents_are_exact(spark, kind):
    from decimal import Decimal

    texts = ["0.01", "1.15", "-2.35", "104949.99", "999999999.99"]
    values = [float(t) if kind == "double" else Decimal(t) for t in texts]
    assert evaluate(spark, values, lambda c: amount(cents(c)), kind) == [Decimal(t) for t in texts]
