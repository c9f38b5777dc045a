from datetime import datetime
from decimal import Decimal as D

import pytest

from feira.operators import analytics


@pytest.fixture
def shop(spark):
    clientes = spark.createDataFrame(
        [(1, "Ana", "ana@x.pt", "Porto"), (2, "Rui", "rui@x.pt", "Porto"), (3, "Eva", "eva@x.pt", "Faro"),
         (4, "Sem", "sem@x.pt", "Faro")],
        "id long, nome string, email string, distrito string",
    )
    produtos = spark.createDataFrame(
        [(1, "b", "X"), (2, "a", "X"), (3, "a", "X"), (4, "c", "Y"), (5, "unsold", "Z")],
        "id long, nome string, categoria string",
    )
    transacoes = spark.createDataFrame(
        [(1, 1, datetime(2025, 1, 31, 23, 59)), (2, 2, datetime(2025, 2, 1)), (3, 3, datetime(2025, 2, 2)),
         (4, 9, datetime(2025, 2, 3)), (5, 1, datetime(2025, 3, 1))],
        "id long, id_cliente long, data_hora timestamp_ntz",
    )
    itens = spark.createDataFrame(
        [(1, 1, 5, D("1.00")), (1, 2, 5, D("1.01")), (2, 3, 5, D("2.01")), (3, 4, 1, D("4.00")),
         (4, 4, 1, D("100.00")), (77, 4, 1, D("1.00"))],
        "id_transacao long, id_produto long, quantidade int, preco_unitario decimal(10,2)",
    )
    return clientes, produtos, transacoes, itens


def test_top_customers(shop):
    clientes, _, transacoes, itens = shop
    top = analytics.top_customers(clientes, transacoes, itens, n=2).collect()
    # Equal totals go by id; an unknown customer's order does not count.
    assert [(r.id_cliente, r.total_gasto) for r in top] == [(1, D("10.05")), (2, D("10.05"))]


def test_best_sellers_keep_shared_first_place(shop, rows):
    _, produtos, _, itens = shop
    best = analytics.best_sellers(produtos, itens)
    assert rows(best) == [("X", 2, "a", 5), ("X", 3, "a", 5), ("Y", 4, "c", 3)]


def test_monthly_trend(shop, rows):
    _, _, transacoes, itens = shop
    assert rows(analytics.monthly_trend(transacoes, itens)) == [
        (datetime(2025, 1, 1), D("10.05")), (datetime(2025, 2, 1), D("114.05")),
    ]


def test_aov(shop):
    clientes, _, transacoes, itens = shop
    got = [tuple(r) for r in analytics.aov_by_district(clientes, transacoes, itens).collect()]
    assert got == [("Porto", D("10.05"), 2, D("20.10")), ("Faro", D("4.00"), 1, D("4.00"))]


def test_aov_rounds_half_up(spark):
    clientes = spark.createDataFrame([(1, "Porto")], "id long, distrito string")
    transacoes = spark.createDataFrame(
        [(1, 1, datetime(2025, 1, 1)), (2, 1, datetime(2025, 1, 1))], "id long, id_cliente long, data_hora timestamp_ntz"
    )
    itens = spark.createDataFrame(
        [(1, 1, 1, D("0.01")), (2, 1, 1, D("0.02"))],
        "id_transacao long, id_produto long, quantidade int, preco_unitario decimal(10,2)",
    )
    assert analytics.aov_by_district(clientes, transacoes, itens).first()["valor_medio_encomenda"] == D("0.02")


def test_rank_filter_runs_before_the_shuffle(shop):
    _, produtos, _, itens = shop
    plan = analytics.best_sellers(produtos, itens)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
