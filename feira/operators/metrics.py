"""Customer value and revenue by day, week and month.

Both take the line fact or the order fact: any rows with `total_linha` and their keys.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feira.functions.calendar import iso_week, iso_year, month_label
from feira.functions.money import total
from feira.schemas import TOTAL


def _total(column: str) -> Column:
    # A group whose values are all NULL is worth 0, not NULL.
    return F.coalesce(total(F.col(column)), F.lit(0)).cast(TOTAL)


def customer_lifetime_value(fact: DataFrame) -> DataFrame:
    """Total spend per known customer."""
    return (
        fact.where(F.col("customer_id").isNotNull())
        .groupBy("customer_id")
        .agg(_total("total_linha").alias("customer_lifetime_value"))
    )


class Revenue(NamedTuple):
    daily: DataFrame
    weekly: DataFrame
    monthly: DataFrame
    weekly_iso: DataFrame


def revenue_over_time(fact: DataFrame, keep_undated: bool = False) -> Revenue:
    """Daily totals, and the coarser ones rolled up from those few rows.

    `weekly` merges equal week numbers of all years; `weekly_iso` keeps years apart.
    With keep_undated, undated rows form a month labelled 'NaT'.
    """
    by_day = fact.groupBy("date").agg(total(F.col("total_linha")).alias("total"))
    dated = by_day.where(F.col("date").isNotNull())
    label = month_label(F.col("date"))
    months = by_day if keep_undated else dated
    if keep_undated:
        label = F.coalesce(label, F.lit("NaT"))
    week = iso_week(F.col("date")).alias("week")
    return Revenue(
        daily=dated.select("date", F.coalesce("total", F.lit(0)).cast(TOTAL).alias("daily_revenue")),
        weekly=dated.groupBy(week).agg(_total("total").alias("weekly_revenue")),
        monthly=months.groupBy(label.alias("month")).agg(_total("total").alias("monthly_revenue")),
        weekly_iso=dated.groupBy(iso_year(F.col("date")).alias("iso_year"), week).agg(
            _total("total").alias("weekly_revenue")
        ),
    )
