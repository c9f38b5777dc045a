"""Table-level expectations: one scan per table, one result row per rule and column."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feira.functions.calendar import parse_datetime
from feira.functions.validation import has_at_sign


@dataclass(frozen=True)
class Expectation:
    rule: str
    column: str

    def fails(self) -> Column:
        c = F.col(self.column)
        match self.rule:
            case "not_null":
                return c.isNull()
            case "positive":  # NULL passes
                return c <= 0
            case "email":  # NULL fails
                return ~has_at_sign(c)
            case "timestamp":  # NULL fails
                return parse_datetime(c).isNull()
        raise ValueError(f"unknown rule {self.rule!r}")

    def message(self) -> str:
        return MESSAGES[self.rule].format(self.column)


# Report wording per rule.
MESSAGES = {
    "not_null": "Nulls found in column '{}'",
    "positive": "Non-positive values in column '{}'",
    "email": "Invalid email addresses in '{}'",
    "timestamp": "Invalid timestamps in '{}'",
}


def _suite(**rules: list[str]) -> list[Expectation]:
    return [Expectation(rule, column) for rule, columns in rules.items() for column in columns]


SUITES: dict[str, list[Expectation]] = {
    "clientes": _suite(not_null=["id", "email"], email=["email"]),
    "produtos": _suite(not_null=["id", "preco"], positive=["preco"]),
    "transacoes": _suite(not_null=["id", "id_cliente", "data_hora"], timestamp=["data_hora"]),
    "transacao_itens": _suite(
        not_null=["id", "id_transacao", "id_produto", "quantidade", "preco_unitario"],
        positive=["quantidade", "preco_unitario"],
    ),
}


def check_table(name: str, df: DataFrame, suite: list[Expectation] | None = None) -> DataFrame:
    """(tabela, regra, coluna, linhas_falhadas) for every rule of the suite."""
    suite = SUITES[name] if suite is None else suite
    counts = df.agg(*[F.count_if(e.fails()).alias(f"r{i}") for i, e in enumerate(suite)])
    results = F.array(
        *[
            F.struct(
                F.lit(e.rule).alias("regra"), F.lit(e.column).alias("coluna"),
                F.col(f"r{i}").alias("linhas_falhadas"),
            )
            for i, e in enumerate(suite)
        ]
    )
    return counts.select(F.lit(name).alias("tabela"), F.inline(results))


def check_tables(
    tables: dict[str, DataFrame], suites: dict[str, list[Expectation]] | None = None
) -> DataFrame:
    suites = SUITES if suites is None else suites
    checked = [check_table(name, tables[name], suite) for name, suite in suites.items()]
    return reduce(DataFrame.unionByName, checked)


def total_issues(results: DataFrame) -> DataFrame:
    """Issues are failing rules, not failing rows."""
    return results.agg(F.count_if(F.col("linhas_falhadas") > 0).alias("total_issues"))
