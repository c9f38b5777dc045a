"""The transaction fact: one row per order line, or rolled up to one row per order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feira.functions.calendar import parse_datetime
from feira.functions.money import amount, cents, line_amount
from feira.schemas import PRICE

FACT_COLUMNS = [
    "transaction_id", "customer_id", "product_id", "quantidade",
    "preco", "total_linha", "data_hora", "date",
]


def _lines_with_price(
    itens: DataFrame, produtos: DataFrame | None, price_basis: str
) -> DataFrame:
    """Lines with `preco` and its whole cents, from the catalog or as charged."""
    price = F.col("preco").cast(PRICE)
    if price_basis == "catalog":
        lines = itens.select("id_transacao", "id_produto", "quantidade")
        prices = produtos.select(
            F.col("id").alias("id_produto"), price.alias("preco"), cents(price).alias("centimos")
        )
        return lines.join(prices, "id_produto", "left")
    if price_basis == "charged":
        charged = itens.withColumn("preco", F.col("preco_unitario"))
        return charged.select(
            "id_transacao", "id_produto", "quantidade",
            price.alias("preco"), cents(price).alias("centimos"),
        )
    raise ValueError(f"price_basis must be 'catalog' or 'charged', not {price_basis!r}")


def _line_cents() -> Column:
    return F.col("quantidade").cast("bigint") * F.col("centimos")


def _order_heads(transacoes: DataFrame) -> DataFrame:
    return transacoes.select(
        F.col("id").alias("id_transacao"),
        F.col("id_cliente").alias("customer_id"),
        parse_datetime(F.col("data_hora")).alias("data_hora"),
    )


def transaction_fact(
    transacoes: DataFrame, itens: DataFrame, produtos: DataFrame,
    price_basis: str = "catalog",
) -> DataFrame:
    """Order lines with price, line total, customer and time.

    Lines whose product or order is unknown stay, with NULLs in those columns. A hot
    product or order is one shuffle partition of lines, which adaptive execution splits:
    both are left joins, whose left side may be read in parts.
    """
    priced = _lines_with_price(itens, produtos, price_basis)
    lines = priced.join(_order_heads(transacoes), "id_transacao", "left")
    return lines.select(
        F.col("id_transacao").alias("transaction_id"),
        "customer_id",
        F.col("id_produto").alias("product_id"),
        "quantidade", "preco",
        line_amount(_line_cents()).alias("total_linha"),
        "data_hora",
        F.to_date("data_hora").alias("date"),
    )


def order_fact(
    transacoes: DataFrame, itens: DataFrame, produtos: DataFrame,
    price_basis: str = "catalog",
) -> DataFrame:
    """The fact summed to order grain before it meets the orders.

    Sums per customer or date over this are equal to those over the line fact, but
    lines are combined map-side and the orders join is one row to one row, so a hot
    order cannot skew it.
    """
    priced = _lines_with_price(itens, produtos, price_basis)
    totals = priced.groupBy("id_transacao").agg(amount(F.sum(_line_cents())).alias("total_linha"))
    return totals.join(_order_heads(transacoes), "id_transacao", "left").select(
        F.col("id_transacao").alias("transaction_id"),
        "customer_id", "total_linha", "data_hora",
        F.to_date("data_hora").alias("date"),
    )


def order_revenue(
    transacoes: DataFrame, itens: DataFrame, valor: Column | str | None = None
) -> DataFrame:
    """Charged revenue of each order that has lines; orders and lines must both exist.

    valor is the line total as charged; by default quantidade * preco_unitario.
    """
    if valor is None:
        line_cents = F.col("quantidade").cast("bigint") * cents(F.col("preco_unitario"))
    else:
        line_cents = cents(F.col(valor) if isinstance(valor, str) else valor)
    per_order = itens.groupBy("id_transacao").agg(amount(F.sum(line_cents)).alias("receita"))
    heads = transacoes.select(F.col("id").alias("id_transacao"), "id_cliente", "data_hora")
    return per_order.join(heads, "id_transacao")
