"""Whole tables from a relational database, read in parallel key ranges."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from feira.schemas import ENTITIES


def jdbc_options(
    url: str, table: str, schema: str = "public", key: str = "id",
    bounds: tuple[int, int] | None = None, partitions: int = 1, **extra: str,
) -> dict[str, str]:
    """Reader options. bounds only split the key range over tasks; they filter nothing."""
    options = {"url": url, "dbtable": f"{schema}.{table}", "fetchsize": "10000", **extra}
    if bounds is not None:
        low, high = bounds
        options |= {
            "partitionColumn": key,
            "lowerBound": str(low),
            "upperBound": str(high),
            "numPartitions": str(partitions),
        }
    return options


def key_bounds(spark: SparkSession, url: str, table: str, schema: str = "public", key: str = "id",
               **extra: str) -> tuple[int, int] | None:
    """Lowest and highest key, asked of the database; None for an empty table."""
    query = f"SELECT min({key}) AS low, max({key}) AS high FROM {schema}.{table}"
    row = spark.read.format("jdbc").options(url=url, query=query, **extra).load().first()
    return None if row["low"] is None else (row["low"], row["high"])


def read_database(
    spark: SparkSession, url: str, partitions: int, schema: str = "public", **extra: str
) -> dict[str, DataFrame]:
    """The four entities, each read in so many key ranges; filters and columns used later
    are pushed to the database."""
    return {
        name: spark.read.format("jdbc")
        .options(**jdbc_options(
            url, name, schema, bounds=key_bounds(spark, url, name, schema, **extra),
            partitions=partitions, **extra,
        ))
        .load()
        for name in ENTITIES
    }
