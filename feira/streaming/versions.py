"""The newest version of each key as keyed state of a stream.

Instead of merging every micro-batch into a table, the stream holds each key's newest versions
as state and passes on only what is newer. Versions that lie far enough behind the watermark
are forgotten: whatever could still come for them would be older.

State is an aggregate by key and window of time, which Spark keeps, compares and forgets. Windows
are two spans of `late` long and begin every span. Of a version only those that are newer by
`late` or less can have come before it in time, and all those lie with it in the window that
begins with its span; so it is new if it is the newest there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feira.operators.merge import latest_version

LATE = "2 days"


def _micros(spark: SparkSession, interval: str) -> int:
    epoch = F.timestamp_micros(F.lit(0))
    return spark.range(1).select(F.unix_micros(epoch + F.expr(f"interval {interval}"))).first()[0]


def newest_versions(
    changes: DataFrame, key: str = "id", version: str = "version_timestamp", late: str = LATE,
) -> DataFrame:
    """The rows of changes that are newer than all before them of their key, in update mode.

    Of a key one micro-batch may give several rows, of different spans of time. Rows without a
    key or version are left out. Of equal versions the one whose other columns are larger
    counts, as in `latest_version`, so the order of files does not matter as long as no row
    comes more than `late` behind the newest version of all. Rows that do are dropped once their
    windows are forgotten.
    """
    names = changes.columns
    rest = [c for c in names if c not in (key, version)]
    span = max(_micros(changes.sparkSession, late), 1_000_000)
    # The time of the micro-batch, so that of equal rows the one that came first is the largest.
    came = -F.unix_micros(F.current_timestamp())
    timely = changes.where(F.col(key).isNotNull() & F.col(version).isNotNull()).withColumns(
        {"_key": F.col(key).cast("string"), "_at": F.col(version).cast("timestamp"), "_came": came}
    ).withWatermark("_at", late)
    row = F.struct(version, *rest, "_came", key)
    best = timely.groupBy(
        "_key", F.window("_at", f"{2 * span} microseconds", f"{span} microseconds").alias("_window")
    ).agg(F.max(row).alias("_best"))
    at = F.unix_micros(F.col(f"_best.{version}").cast("timestamp"))
    newer = best.where((F.col("_best._came") == came) & (at - F.unix_micros("_window.start") < span))
    return newer.select(*[F.col(f"_best.{c}").alias(c) for c in names])


def follow_available(
    changes: DataFrame, path: str, checkpoint: str, key: str = "id", version: str = "version_timestamp",
    late: str = LATE,
) -> None:
    """Add the newer versions among all unread changes to path, restarting where the
    checkpoint left off. A micro-batch that is repeated replaces what it wrote."""
    def write(batch: DataFrame, n: int) -> None:
        latest_version(batch, key, version).write.mode("overwrite").option(
            "partitionOverwriteMode", "static"
        ).parquet(f"{path}/batch={n}")

    query = (
        newest_versions(changes, key, version, late).writeStream.foreachBatch(write).outputMode("update")
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()


def read_newest(
    spark: SparkSession, path: str, key: str = "id", version: str = "version_timestamp"
) -> DataFrame:
    """The newest version of each key among those passed on so far."""
    return latest_version(spark.read.parquet(path).drop("batch"), key, version)
