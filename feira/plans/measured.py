"""Writes that measure themselves: rows, missing values and time of each output."""

from __future__ import annotations

import time
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

METRICS = "run long, table_name string, n_rows long, nulls map<string, long>, seconds double, finished_at timestamp"


class Measured(NamedTuple):
    table_name: str
    n_rows: int
    nulls: dict[str, int]  # of each column
    seconds: float


def measured_write(df: DataFrame, name: str, write: Callable[[DataFrame], object]) -> Measured:
    """Have write() write df, and measure what it wrote while it does.

    The counts are taken by the tasks that write, on the rows that they write; nothing is
    read again, and a task that is repeated counts once.
    """
    seen = Observation()
    missing = [F.count_if(F.col(f"`{c}`").isNull()).alias(f"nulls_{i}") for i, c in enumerate(df.columns)]
    observed = df.observe(seen, F.count(F.lit(1)).alias("n_rows"), *missing)
    started = time.monotonic()
    write(observed)
    seconds = time.monotonic() - started
    found = seen.get
    return Measured(name, found["n_rows"], {c: found[f"nulls_{i}"] for i, c in enumerate(df.columns)}, seconds)


def append_metrics(spark: SparkSession, path: str, run: int, outputs: list[Measured]) -> None:
    rows = spark.createDataFrame(
        [(run, m.table_name, m.n_rows, m.nulls, m.seconds, None) for m in outputs], METRICS
    ).withColumn("finished_at", F.current_timestamp())
    rows.coalesce(1).write.mode("append").parquet(path)


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(METRICS).parquet(path)
