"""Click windows over a stream, with events that came too late as a second output.

A window is closed when the watermark, `late` behind the newest event of all earlier batches,
passes its end; what comes for it after that is late. Each micro-batch adds the partial sums of
its timely events to one output and its late events, as they came, to another. Closed windows
are the timely sums alone, as a reader saw them when they closed; corrections are the windows
that late events belong to, summed anew with them. Each output is a folder for each batch,
which a replayed batch replaces, and one appended row that commits the batch's watermark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feira.operators.clicks import MEASURES, flat, measures
from feira.plans.tables import read_if_there
from feira.schemas import MEASURED

LATE = "2 days"
KEYS = ["window", "event_type"]
PARTIAL = f"window struct<start: timestamp, end: timestamp>, event_type string, n_events long, total_value decimal(38,{MEASURED.scale})"


def _committed(spark: SparkSession, root: str) -> DataFrame | None:
    return read_if_there(spark, f"{root}/batches")


def _watermark(spark: SparkSession, root: str, before: int | None = None):
    """The watermark after the batches committed before a batch (all, if not given)."""
    batches = _committed(spark, root)
    if batches is None:
        return None
    earlier = batches if before is None else batches.where(F.col("batch") < before)
    return earlier.agg(F.max("watermark")).first()[0]


def split_available(
    events: DataFrame, root: str, checkpoint: str, size: str = "1 hour", late: str = LATE,
) -> None:
    """Add all unread events to the outputs under root, restarting where the checkpoint left
    off. Events without a time belong to no window and are left out."""
    def add(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        passed = _watermark(spark, root, number)
        rows = batch.where(F.col("ts").isNotNull()).withColumn("window", F.window("ts", size))
        is_late = F.lit(False) if passed is None else F.col("window.end") <= F.lit(passed)
        rows = rows.withColumn("_late", is_late).persist()
        try:
            newest = rows.agg(F.max("ts").alias("newest")).select(F.col("newest") - F.expr(f"interval {late}")).first()[0]
            if newest is None:
                return
            rows.where("not _late").groupBy(*KEYS).agg(*measures()).write.mode("overwrite").parquet(f"{root}/timely/batch={number}")
            rows.where("_late").drop("_late", "window").write.mode("overwrite").parquet(f"{root}/late/batch={number}")
        finally:
            rows.unpersist()
        spark.range(1).select(
            F.lit(number).cast("long").alias("batch"), F.lit(newest).cast("timestamp").alias("watermark")
        ).coalesce(1).write.mode("append").parquet(f"{root}/batches")

    query = (
        events.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()


def _parts(spark: SparkSession, root: str, name: str, schema: str) -> DataFrame:
    """The rows of committed batches of an output; without a commit a batch is not there."""
    batches = _committed(spark, root)
    found = read_if_there(spark, f"{root}/{name}") if batches is not None else None
    if found is None:
        return spark.createDataFrame([], schema)
    return found.join(batches.select("batch").distinct(), "batch", "left_semi")


def _merged(parts: DataFrame) -> DataFrame:
    return parts.groupBy(*KEYS).agg(*[F.sum(m).alias(m) for m in MEASURES])


def closed_windows(spark: SparkSession, root: str) -> DataFrame:
    """The windows that the watermark has passed, without their late events."""
    passed = _watermark(spark, root)
    timely = _parts(spark, root, "timely", PARTIAL).drop("batch")
    return flat(_merged(timely.where(F.col("window.end") <= F.lit(passed).cast("timestamp"))))


def late_events(spark: SparkSession, root: str, events: str) -> DataFrame:
    """The events that came after their window was closed, with the batch they came in; events
    is their schema."""
    return _parts(spark, root, "late", f"{events}, batch int")


def corrections(spark: SparkSession, root: str, events: str, size: str = "1 hour") -> DataFrame:
    """The windows that late events belong to, with them."""
    late = late_events(spark, root, events).groupBy(F.window("ts", size), "event_type").agg(*measures())
    timely = _parts(spark, root, "timely", PARTIAL).select("window", "event_type", *MEASURES)
    touched = timely.join(late.select(*KEYS), KEYS, "left_semi")
    return flat(_merged(touched.unionByName(late.select(*touched.columns))))


def corrected_windows(closed: DataFrame, corrected: DataFrame) -> DataFrame:
    """Closed windows, each replaced by its correction if there is one."""
    keys = ["window_start", "event_type"]
    kept = closed.join(corrected.select(*keys), keys, "left_anti")
    return kept.select(*corrected.columns).unionByName(corrected)
