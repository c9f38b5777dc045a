"""Queries that SQL can express, against their SQL."""

import re

import pytest

pytest.importorskip("duckdb")

import __spark_entry__ as entry
from check_oracle import compare, connect
from feira.llm.oracle import ORACLE_SQL
from feira.llm.queries import QUERIES


def test_operators_and_the_pipeline():
    numbers = [int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES]
    assert sorted(numbers) == list(range(1, 14))
    assert {*QUERIES, "pipeline"} <= entry.queries().keys()


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_against_sql(spark, sf_dir, name):
    assert compare(spark, connect(sf_dir), name, QUERIES[name], ORACLE_SQL[name], sf_dir) is None
