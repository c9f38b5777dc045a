from datetime import date, datetime
from decimal import Decimal as D

import pytest

from feira.operators.fact import FACT_COLUMNS, order_fact, transaction_fact
from feira.operators.metrics import customer_lifetime_value, revenue_over_time
from feira.operators.copurchase import co_purchases


def tables(spark, produtos, transacoes, itens):
    p = spark.createDataFrame(produtos, "id long, nome string, categoria string, preco decimal(10,2), fornecedor string")
    t = spark.createDataFrame(transacoes, "id long, id_cliente long, data_hora string, metodo_pagamento string")
    i = spark.createDataFrame(itens, "id long, id_transacao long, id_produto long, quantidade int, preco_unitario decimal(10,2)")
    return t, i, p


@pytest.fixture
def simple(spark):
    return tables(
        spark,
        [(101, "P1", "C", D("10.00"), "F"), (102, "P2", "C", D("5.00"), "F")],
        [(1, 11, "2025-10-01 10:00:00", "Card"), (2, 22, "2025-10-02 12:00:00", "MB Way")],
        [(1, 1, 101, 2, D("9.00")), (2, 2, 102, 3, D("5.00"))],
    )


@pytest.fixture
def messy(spark):
    """Unknown product, unknown order, bad time, no customer."""
    return tables(
        spark,
        [(1, "A", "C", D("10.00"), "F"), (2, "B", "C", D("0.10"), "F")],
        [(1, 11, "2020-12-31 10:00:00", "x"), (2, 11, "2021-01-03", "x"), (3, None, "2021-01-03 01:00:00", "x"),
         (4, 44, "not a time", "x"), (5, 55, "2022-01-05", "x")],
        [(1, 1, 1, 2, D("1.00")), (2, 2, 2, 3, D("1.00")), (3, 3, 1, 1, D("1.00")), (4, 4, 1, 1, D("1.00")),
         (5, 5, 99, 1, D("1.00")), (6, 77, 1, 1, D("1.00"))],
    )


def test_fact_of_two_orders(simple, rows):
    fact = transaction_fact(*simple)
    assert fact.columns == FACT_COLUMNS
    assert rows(fact, "transaction_id", "total_linha", "date") == [
        (1, D("20.00"), date(2025, 10, 1)), (2, D("15.00"), date(2025, 10, 2)),
    ]
    assert rows(customer_lifetime_value(fact)) == [(11, D("20.00")), (22, D("15.00"))]
    assert co_purchases(fact).isEmpty()
    revenue = revenue_over_time(fact)
    assert sorted(r["daily_revenue"] for r in revenue.daily.collect()) == [15, 20]
    assert rows(revenue.weekly) == [(40, D("35.00"))]
    assert rows(revenue.monthly) == [("2025-10", D("35.00"))]


def test_charged_prices(simple, rows):
    fact = transaction_fact(*simple, price_basis="charged")
    assert rows(fact, "transaction_id", "total_linha") == [(1, D("18.00")), (2, D("15.00"))]
    with pytest.raises(ValueError):
        transaction_fact(*simple, price_basis="wholesale")


def test_unmatched_lines_stay(messy, rows):
    fact = transaction_fact(*messy)
    got = rows(fact, "transaction_id", "customer_id", "product_id", "total_linha", "data_hora")
    assert got == sorted([
        (1, 11, 1, D("20.00"), datetime(2020, 12, 31, 10)),
        (2, 11, 2, D("0.30"), datetime(2021, 1, 3)),
        (3, None, 1, D("10.00"), datetime(2021, 1, 3, 1)),
        (4, 44, 1, D("10.00"), None),
        (5, 55, 99, None, datetime(2022, 1, 5)),
        (77, None, 1, D("10.00"), None),
    ], key=repr)


@pytest.mark.parametrize("make", [transaction_fact, order_fact])
def test_metrics_on_either_grain(messy, rows, make):
    fact = make(*messy)
    # A customer whose only value is NULL is worth 0; unknown customers are left out.
    assert rows(customer_lifetime_value(fact)) == [(11, D("20.30")), (44, D("10.00")), (55, D("0.00"))]
    r = revenue_over_time(fact)
    assert rows(r.daily) == [
        (date(2020, 12, 31), D("20.00")), (date(2021, 1, 3), D("10.30")), (date(2022, 1, 5), D("0.00")),
    ]
    assert rows(r.weekly) == [(1, D("0.00")), (53, D("30.30"))]
    assert rows(r.weekly_iso) == [(2020, 53, D("30.30")), (2022, 1, D("0.00"))]
    assert rows(r.monthly) == [("2020-12", D("20.00")), ("2021-01", D("10.30")), ("2022-01", D("0.00"))]
    undated = revenue_over_time(fact, keep_undated=True).monthly
    assert ("NaT", D("20.00")) in rows(undated)


def test_same_week_number_of_two_years_collides(spark, rows):
    t = tables(
        spark, [(1, "A", "C", D("1.00"), "F")],
        [(1, 1, "2023-01-04", "x"), (2, 1, "2024-01-03", "x")],
        [(1, 1, 1, 1, D("1.00")), (2, 2, 1, 2, D("1.00"))],
    )
    r = revenue_over_time(transaction_fact(*t))
    assert rows(r.weekly) == [(1, D("3.00"))]
    assert rows(r.weekly_iso) == [(2023, 1, D("1.00")), (2024, 1, D("2.00"))]


def test_duplicate_product_ids_repeat_lines(spark):
    t = tables(
        spark, [(1, "A", "C", D("1.00"), "F"), (1, "A2", "C", D("2.00"), "F")],
        [(1, 1, "2023-01-04", "x")], [(1, 1, 1, 1, D("1.00"))],
    )
    assert transaction_fact(*t).count() == 2
