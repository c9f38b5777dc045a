"""The incremental load as a stream: each micro-batch is merged into the fact."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feira.plans.tables import merge_into


def read_changes(spark: SparkSession, path: str, schema: T.StructType, **options: str) -> DataFrame:
    return spark.readStream.schema(schema).options(**options).parquet(path)


def merge_available(
    changes: DataFrame, fact_path: str, checkpoint: str, at: str | None = None, **merge: object
) -> None:
    """Merge all unread changes, restarting where the checkpoint left off.

    With `at` the fact lies by month of that column, else by buckets of the key. A micro-batch
    that is replayed after a crash is merged again without effect. A batch may arrive with
    older versions than the fact holds, so newer_only is the sensible setting when files are
    not in version order.
    """
    place = None if at is None else F.col(at)

    def merge_batch(batch: DataFrame, _: int) -> None:
        batch = batch.persist()  # the merge reads it several times
        try:
            merge_into(batch, fact_path, at=place, **merge)
        finally:
            batch.unpersist()

    query = (
        changes.writeStream.foreachBatch(merge_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
