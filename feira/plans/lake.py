"""Bronze, silver and gold layers in partitioned Parquet, and compaction."""

from __future__ import annotations

from datetime import datetime
from hashlib import sha256
from re import fullmatch
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feira.functions.calendar import month_label
from feira.operators.merge import latest_version
from feira.operators.row_rules import valid_rows
from feira.plans.tables import read_partitions, replace_partitions
from feira.schemas import conform

MONTH = "month"
INGESTED = "_ingested_at"


def delivery_id(raw: DataFrame, at: datetime) -> str:
    """The name of a delivery by its time and its contents, in whatever order its rows come."""
    whole = F.xxhash64(*[F.col(f"`{c}`") for c in raw.columns])
    found = raw.agg(
        F.count(F.lit(1)).alias("n"), F.bit_xor(whole).alias("x"), F.sum(F.shiftright(whole, 16)).alias("s")
    ).first()
    digest = sha256(repr((raw.columns, *found)).encode()).hexdigest()[:16]
    return f"{at:%Y%m%dT%H%M%S%f}-{digest}"


def bronze_append(raw: DataFrame, root: str, table: str, at: datetime, delivery: str | None = None) -> str:
    """Keep the delivery as it came, as text, with its time of arrival.

    Each delivery has its own partition, named by its id: retrying one replaces it, and nothing
    else does. Without an id a delivery is known by its time of arrival and its rows, so
    different deliveries of one moment are kept side by side.
    """
    path = f"{root}/bronze/{table}"
    text = raw.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in raw.columns if c != INGESTED])
    delivery = delivery or delivery_id(text, at)
    if not fullmatch(r"[\w.+-]+", delivery):
        raise ValueError(f"a delivery id may hold letters, digits, and _ . + - only: {delivery!r}")
    arrived = F.lit(at).cast("timestamp")
    text.withColumn(INGESTED, arrived).write.mode("overwrite").option(
        "partitionOverwriteMode", "static"
    ).parquet(f"{path}/delivery={delivery}")
    return path


def read_bronze(spark: SparkSession, path: str) -> DataFrame:
    # Deliveries may have brought new columns; older ones hold NULL there.
    bronze = spark.read.option("basePath", path).option("mergeSchema", True).parquet(path)
    return bronze.select(*[c for c in bronze.columns if c not in ("delivery", INGESTED)], INGESTED)


class Refined(NamedTuple):
    silver: DataFrame
    quarantine: DataFrame


def refine(bronze: DataFrame, table: str) -> Refined:
    """Typed, latest row per id; rows that break a row rule go to quarantine whole."""
    ok = valid_rows(table, bronze)
    marked = bronze.withColumn("_ok", ok)
    latest = latest_version(marked.where("_ok").drop("_ok"), "id", INGESTED)
    return Refined(conform(latest, table), marked.where(~F.col("_ok")).drop("_ok"))


def write_by_month(df: DataFrame, path: str, at: Column) -> None:
    """The table as df holds it, partitioned by month; undated rows get their own partition.

    A row that a correction moved to another month is gone from its old one, and months
    that no row is left in are gone too.
    """
    label = F.coalesce(month_label(at), F.lit("undated"))
    replace_partitions(df.withColumn(MONTH, label), path, MONTH)


def read_silver(spark: SparkSession, path: str) -> DataFrame | None:
    return read_partitions(spark, path)


def compact(spark: SparkSession, path: str, column: str, values: list[str]) -> None:
    """Rewrite the given partitions into files of the advisory size."""
    chosen = read_partitions(spark, path, values)
    if chosen is not None:
        replace_partitions(chosen, path, column, gone=[])
