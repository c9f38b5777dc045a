"""Row-level rules on raw text: one output row per violation, no shuffle."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feira.functions.validation import (
    is_blank, is_valid_date, is_valid_email, parse_integer, parse_number,
)


def _violation(failed: Column, rule: str, column: str) -> Column:
    return F.when(
        failed,
        F.struct(
            F.lit(rule).alias("regra"), F.lit(column).alias("coluna"), F.col(column).alias("valor")
        ),
    )


@dataclass(frozen=True)
class Rule:
    """What a value must satisfy, and how each way of failing is named."""

    column: str
    valid: Column
    failures: dict[str, Column]

    def violations(self) -> list[Column]:
        return [_violation(failed, name, self.column) for name, failed in self.failures.items()]


def _must(column: str, valid: Column, failure: str) -> Rule:
    return Rule(column, valid, {failure: ~valid})


def _positive(column: str, parsed: Column, noun: str) -> Rule:
    return Rule(
        column,
        F.coalesce(parsed > 0, F.lit(False)),
        {f"invalid {noun}": parsed.isNull(), f"non-positive {noun}": parsed <= 0},
    )


def _rules(table: str, fields: list[str]) -> list[Rule]:
    present = [_must(c, ~is_blank(F.col(c)), "null value") for c in fields]
    match table:
        case "clientes":
            return present + [
                _must("email", is_valid_email(F.col("email")), "invalid email"),
                _must("data_registo", is_valid_date(F.col("data_registo")), "invalid date"),
            ]
        case "produtos":
            return present + [_positive("preco", parse_number(F.col("preco")), "price")]
        case "transacoes":
            return present + [
                _must("data_hora", is_valid_date(F.col("data_hora")), "invalid timestamp")
            ]
        case "transacao_itens":
            return present + [
                _positive("quantidade", parse_integer(F.col("quantidade")), "quantity"),
                _positive("preco_unitario", parse_number(F.col("preco_unitario")), "unit price"),
            ]
    raise ValueError(f"no row rules for {table!r}")


def _rules_of(table: str, raw: DataFrame) -> list[Rule]:
    return _rules(table, [c for c in raw.columns if not c.startswith("_")])


def valid_rows(table: str, raw: DataFrame) -> Column:
    """True for rows without any violation, for splitting a table in one pass."""
    return reduce(lambda a, b: a & b, [r.valid for r in _rules_of(table, raw)])


def violations(
    table: str, raw: DataFrame, key: str = "id", place: dict[str, str] | None = None, malformed: str | None = None,
) -> DataFrame:
    """(tabela, chave, regra, coluna, valor) of an all-text table.

    Every empty field is a violation, beside those of its own rule: an empty price is
    reported both as empty and as invalid. Good rows leave at the filter, so violations
    are only spelled out for the bad ones. `place` names columns of raw that say where a row
    stands, and how the result calls them. A row with a value in the column `malformed`, which
    is then its whole line, has a wrong number of fields, whatever became of its fields.
    """
    place, good = place or {}, valid_rows(table, raw)
    each = [v for r in _rules_of(table, raw) for v in r.violations()]
    if malformed:
        good = good & F.col(malformed).isNull()
        each.append(F.when(F.col(malformed).isNotNull(), F.struct(
            F.lit("wrong number of fields").alias("regra"), F.lit(None).cast("string").alias("coluna"),
            F.col(malformed).alias("valor"),
        )))
    return raw.where(~good).select(
        F.lit(table).alias("tabela"), *[F.col(c).alias(name) for c, name in place.items()],
        F.col(key).alias("chave"), F.inline(F.array_compact(F.array(*each))),
    )


def all_violations(tables: dict[str, DataFrame], key: str = "id") -> DataFrame:
    return reduce(
        DataFrame.unionByName, [violations(name, df, key) for name, df in tables.items()]
    )
