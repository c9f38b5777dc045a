"""Click windows over a stream of files, closed by a watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feira.operators.clicks import flat, measures

EVENTS = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("props", T.StringType()),
])
LATE = "2 days"


def read_clicks(spark: SparkSession, path: str, source: str = "parquet", **options: str) -> DataFrame:
    """A stream of events; path may be a folder or a glob. Watermarks need a zoned time."""
    stream = spark.readStream.format(source).schema(EVENTS).options(**options).load(path)
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))


def tumbling(events: DataFrame, size: str = "1 hour", late: str = LATE) -> DataFrame:
    timely = events.withWatermark("ts", late)
    return flat(timely.groupBy(F.window("ts", size), "event_type").agg(*measures()))


def sliding(events: DataFrame, size: str = "1 hour", slide: str = "15 minutes", late: str = LATE) -> DataFrame:
    timely = events.withWatermark("ts", late)
    return flat(timely.groupBy(F.window("ts", size, slide), "event_type").agg(*measures()))


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = LATE) -> DataFrame:
    """Sessions of known users. DEFAULTS have a busy user's sessions merged in each task
    before the shuffle."""
    timely = events.where(F.col("user_id").isNotNull()).withWatermark("ts", late)
    window = F.session_window("ts", gap).alias("window")
    return flat(timely.groupBy("user_id", window).agg(*measures())).withColumnsRenamed(
        {"window_start": "session_start", "window_end": "session_end"}
    )


def run_available(result: DataFrame, path: str, checkpoint: str) -> None:
    """Process what is there, append closed windows to path, and stop."""
    query = (
        result.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(path)
    )
    query.awaitTermination()
