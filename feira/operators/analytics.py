"""The four business reports, on charged prices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feira.functions.calendar import month_start
from feira.functions.money import total
from feira.operators.fact import order_revenue
from feira.schemas import TOTAL


def top_customers(
    clientes: DataFrame, transacoes: DataFrame, itens: DataFrame,
    valor: Column | str | None = None, n: int = 10,
) -> DataFrame:
    """Customers by total spend; equal totals are ordered by id."""
    spend = order_revenue(transacoes, itens, valor).groupBy("id_cliente").agg(
        total(F.col("receita")).alias("total_gasto")
    )
    who = clientes.select(
        F.col("id").alias("id_cliente"), F.col("nome").alias("nome_cliente"), "email", "distrito"
    )
    return (
        who.join(spend, "id_cliente")
        .select("id_cliente", "nome_cliente", "email", "distrito", "total_gasto")
        .orderBy(F.col("total_gasto").desc_nulls_first(), "id_cliente")
        .limit(n)
    )


def best_sellers(produtos: DataFrame, itens: DataFrame) -> DataFrame:
    """Product with most units per category; a shared first place returns all its holders.

    Units are summed per product id before the join, so a hot product is combined
    map-side. The rank filter is pushed below the shuffle, so a task passes on only
    its own leaders of a category.
    """
    units = itens.groupBy("id_produto").agg(
        F.sum(F.col("quantidade").cast("bigint")).alias("unidades_vendidas")
    )
    names = produtos.select(
        "categoria", F.col("id").alias("id_produto"), F.col("nome").alias("nome_produto")
    )
    place = Window.partitionBy("categoria").orderBy(
        F.col("unidades_vendidas").desc_nulls_first(), F.col("nome_produto").asc_nulls_last()
    )
    return (
        names.join(units, "id_produto")
        .withColumn("posicao", F.rank().over(place))
        .where("posicao = 1")
        .select("categoria", "id_produto", "nome_produto", "unidades_vendidas")
        .orderBy("categoria")
    )


def monthly_trend(
    transacoes: DataFrame, itens: DataFrame, valor: Column | str | None = None
) -> DataFrame:
    """Charged revenue per calendar month."""
    return (
        order_revenue(transacoes, itens, valor)
        .groupBy(month_start(F.col("data_hora")).alias("mes"))
        .agg(total(F.col("receita")).alias("receita"))
        .orderBy(F.col("mes").asc_nulls_last())
    )


def aov_by_district(
    clientes: DataFrame, transacoes: DataFrame, itens: DataFrame, valor: Column | str | None = None
) -> DataFrame:
    """Average order value, order count and revenue per district.

    Orders are folded per customer first: that join is then one row to one row, however
    many orders a customer has.
    """
    per_customer = order_revenue(transacoes, itens, valor).groupBy("id_cliente").agg(
        total(F.col("receita")).alias("receita"),
        F.count(F.lit(1)).alias("encomendas"),
        F.count("receita").alias("com_valor"),
    )
    where_from = clientes.select(F.col("id").alias("id_cliente"), "distrito")
    revenue = total(F.col("receita"))
    return (
        where_from.join(per_customer, "id_cliente")
        .groupBy("distrito")
        .agg(
            F.round(F.try_divide(revenue, F.sum("com_valor")), 2)
            .cast(TOTAL).alias("valor_medio_encomenda"),
            F.sum("encomendas").alias("num_encomendas"),
            revenue.alias("receita_total"),
        )
        .orderBy(F.col("valor_medio_encomenda").desc_nulls_first(), "distrito")
    )
