import os

import pytest

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf_dir():
    if not os.path.isdir(SF_DIR):
        pytest.skip("no test tables here")
    return SF_DIR


@pytest.fixture
def table(spark, sf_dir):
    def read(name, *columns):
        rows = spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns).collect()
        return [tuple(r) for r in rows]
    return read


@pytest.fixture
def frame(spark):
    """Rows with more columns whose names the operators use themselves."""
    def make(rows, schema):
        clash = ("_text string, _found int, score double, n_words int, hits int, items int, spans int, "
                 "key int, node int, label string, next int, licenses int, length int, rank int, host int, value int")
        wide = [(*r, *[None] * len(clash.split(","))) for r in rows]
        return spark.createDataFrame(wide, f"{schema}, {clash}")
    return make
