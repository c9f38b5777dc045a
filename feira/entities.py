"""Retail entities over the star-schema test tables (customer, part, orders, lineitem)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feira.schemas import AMOUNT, PRICE

# Line total as charged: the test tables hold it, not the unit price. It stays a double
# of whole cents here; the operators sum it as cents.
CHARGED = "total_cobrado"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def clientes(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation").select("n_nationkey", F.col("n_name").alias("distrito"))
    customer = table(spark, sf_dir, "customer")
    return customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left").select(
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("nome"),
        F.concat(
            F.lower(F.replace("c_name", F.lit("#"), F.lit("."))), F.lit("@exemplo.pt")
        ).alias("email"),
        "distrito",
        F.col("c_mktsegment").alias("segmento"),
        F.col("c_acctbal").cast(AMOUNT).alias("saldo"),
    )


def produtos(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("id"),
        F.col("p_name").alias("nome"),
        F.col("p_type").alias("categoria"),
        F.col("p_retailprice").cast(PRICE).alias("preco"),
        F.col("p_brand").alias("fornecedor"),
        F.col("p_size").alias("tamanho"),
    )


def transacoes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.col("o_custkey").alias("id_cliente"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("data_hora"),
        F.col("o_orderpriority").alias("metodo_pagamento"),
        F.col("o_orderstatus").alias("estado"),
    )


def itens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("id_transacao"),
        F.col("l_partkey").alias("id_produto"),
        F.col("l_quantity").cast("int").alias("quantidade"),
        F.col("l_extendedprice").alias("total_cobrado"),
        F.col("l_shipdate").cast("timestamp_ntz").alias("data_envio"),
        F.col("l_returnflag").alias("devolucao"),
    )
