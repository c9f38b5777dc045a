"""The stored product dimension: closed versions are written once, current ones per run."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feira.operators.scd2 import apply_scd2
from feira.plans.tables import committed_version, publish
from feira.schemas import DIM_PRODUCTS

_STORED = T.StructType([*DIM_PRODUCTS.fields, T.StructField("version", T.LongType())])


def _stored(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(_STORED).parquet(f"{path}/snapshots")


def read_dimension(spark: SparkSession, path: str, last: int | None = None) -> DataFrame:
    """All versions of all products as of the run `last` (the last committed one, if not
    given); empty before the first run."""
    last = committed_version(spark, path) if last is None else last
    if last is None:
        return spark.createDataFrame([], DIM_PRODUCTS)
    shown = (F.col("version") == last) | (~F.col("is_current") & (F.col("version") < last))
    return _stored(spark, path).where(shown).select(*DIM_PRODUCTS.names)


def next_dimension(
    produtos: DataFrame, path: str, last: int | None, as_of: datetime | None = None, strict: bool = False,
) -> DataFrame:
    """What the run after `last` stores: the rows that are current then, and those it closes.

    Rows closed by earlier runs are neither read nor rewritten, however long the history grows.
    """
    spark = produtos.sparkSession
    if last is None:
        current = spark.createDataFrame([], DIM_PRODUCTS)
    else:
        latest = (F.col("version") == last) & F.col("is_current")
        current = _stored(spark, path).where(latest).select(*DIM_PRODUCTS.names)
    return apply_scd2(current, produtos, F.lit(as_of or datetime.now(timezone.utc)), strict)


def update_dimension(
    produtos: DataFrame, path: str, as_of: datetime | None = None, strict: bool = False
) -> None:
    """Apply a product snapshot as one committed run, its current and closed rows partitioned
    apart."""
    last = committed_version(produtos.sparkSession, path)
    run = 0 if last is None else last + 1
    publish(next_dimension(produtos, path, last, as_of, strict), path, run, "is_current")
