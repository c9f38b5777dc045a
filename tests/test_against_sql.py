"""Every registered query against its SQL on the smallest test tables."""

import os

import pytest

pytest.importorskip("duckdb")
SF_DIR = "/root/testdata/sf0.001"
if not os.path.isdir(SF_DIR):
    pytest.skip("no test tables here", allow_module_level=True)

import __spark_entry__ as entry  # noqa: E402
from check_oracle import compare, connect  # noqa: E402
from feira.oracle import ORACLE_SQL  # noqa: E402
from feira.queries import QUERIES  # noqa: E402


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE_SQL)
    assert set(QUERIES) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() == 10


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    assert compare(spark, con, name, QUERIES[name], ORACLE_SQL[name], SF_DIR) is None
