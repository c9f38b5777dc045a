"""Which source feeds the fact, by environment."""

from __future__ import annotations

from pyspark.sql import DataFrame

FACT_INPUTS = ("transacoes", "transacao_itens", "produtos")


class MissingSourceError(RuntimeError):
    """The chosen source lacks a table the fact needs."""


def select_fact_source(
    environment: str | None,
    csv: dict[str, DataFrame],
    database: dict[str, DataFrame],
    landed: dict[str, DataFrame] | None = None,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(transacoes, transacao_itens, produtos): files in 'dev', the database elsewhere.

    The landing zone holds no order lines, so it never feeds the fact; it only makes
    the message more precise.
    """
    in_dev = (environment or "").lower() == "dev"
    source = csv if in_dev else database
    missing = [name for name in FACT_INPUTS if name not in source]
    if missing:
        kind = "csv" if in_dev else "database"
        note = "; the landing zone holds no transacao_itens" if in_dev and landed else ""
        raise MissingSourceError(f"{kind} source lacks {missing}{note}")
    return tuple(source[name] for name in FACT_INPUTS)
