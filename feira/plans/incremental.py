"""Checkpointed incremental load of transactions into the warehouse fact."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feira.operators.increment import EPOCH, increment_since, next_checkpoint
from feira.plans.tables import merge_into, read_if_there, staged


def load_checkpoint(spark: SparkSession, path: str) -> datetime:
    """The furthest event time saved, or the epoch. Saved values are appended and the
    largest counts, so it cannot move back."""
    saved = read_if_there(spark, path)
    last = None if saved is None else saved.agg(F.max("last_processed")).first()[0]
    return last or EPOCH


def save_checkpoint(spark: SparkSession, path: str, at: datetime) -> None:
    row = spark.range(1).select(F.lit(at).cast("timestamp_ntz").alias("last_processed"))
    row.write.mode("append").parquet(path)


def run_incremental(
    transacoes: DataFrame, fact_path: str, state_path: str, buckets: int | None = None, **merge: object
) -> datetime:
    """Merge what is new since the checkpoint, then advance it.

    The fact lies by month of data_hora, so that new events rewrite the last months; or, with a
    number of buckets, by buckets of the id.

    The increment is staged once, so all steps see the same rows even if the source
    moves on. A crash before the checkpoint is saved replays the batch, which changes
    nothing.
    """
    spark = transacoes.sparkSession
    last = load_checkpoint(spark, state_path)
    increment = staged(increment_since(transacoes, last), "increment")
    if increment.isEmpty():
        return last
    at = F.col("data_hora") if buckets is None else None
    merge_into(increment, fact_path, buckets=buckets, at=at, **merge)
    reached = next_checkpoint(increment, last).first()["last_processed"]
    save_checkpoint(spark, state_path, reached)
    return reached
