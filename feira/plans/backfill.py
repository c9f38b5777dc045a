"""Daily runs and backfills: build the fact of given days, then gate them."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feira.operators.expectations import Expectation
from feira.operators.fact import transaction_fact
from feira.plans.quality_gate import run_gate
from feira.plans.tables import read_partitions, replace_partitions, staged

DAY = "day"
FACT_SUITE = [
    Expectation("not_null", "transaction_id"),
    Expectation("not_null", "product_id"),
    Expectation("positive", "quantidade"),
]


def fact_of_days(transacoes: DataFrame, itens: DataFrame, produtos: DataFrame, days: list[date]) -> DataFrame:
    """Fact lines of the given days.

    The plain time bounds reach the scan of transacoes. Lines of other days leave before
    they meet the products.
    """
    at = F.col("data_hora")
    heads = transacoes.where(
        (at >= F.lit(min(days)).cast("timestamp_ntz"))
        & (at < F.date_add(F.lit(max(days)), 1).cast("timestamp_ntz"))
        & F.to_date(at).isin(days)
    )
    lines = itens.join(heads.select(F.col("id").alias("id_transacao")), "id_transacao", "left_semi")
    return transaction_fact(heads, lines, produtos)


def run_days(
    transacoes: DataFrame, itens: DataFrame, produtos: DataFrame, days: Iterable[date], root: str,
) -> str:
    """Rebuild the days' partitions in one job, then check them; raises on any issue.

    Running it again gives the same partitions. A day that no longer has rows is
    emptied.
    """
    days = sorted(set(days))
    path = f"{root}/fact_transactions"
    if not days:
        return path
    spark = transacoes.sparkSession
    fact = staged(fact_of_days(transacoes, itens, produtos, days), "fact-days")
    # Days without rows leave the table in the same commit.
    labels = [day.isoformat() for day in days]
    replace_partitions(fact.withColumn(DAY, F.date_format("date", "yyyy-MM-dd")), path, DAY, gone=labels)
    run_gate({"fact_transactions": fact}, suites={"fact_transactions": FACT_SUITE})
    return path


def run_day(transacoes: DataFrame, itens: DataFrame, produtos: DataFrame, day: date, root: str) -> str:
    return run_days(transacoes, itens, produtos, [day], root)


def read_days(spark: SparkSession, path: str) -> DataFrame | None:
    """The fact lines of all days that were built."""
    held = read_partitions(spark, path)
    return None if held is None else held.drop(DAY)
