"""Windowed aggregates of click events, batch form. Streaming forms: feira.streaming.clicks."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feira.functions.money import measured
from feira.schemas import TOTAL

MEASURES = ["n_events", "total_value"]


def measures() -> list:
    """Number and sum of events; the sum keeps its decimals until `flat` rounds it."""
    return [
        F.count(F.lit(1)).alias("n_events"),
        F.sum(measured(F.col("value"))).alias("total_value"),
    ]


def flat(windowed: DataFrame, name: str = "window") -> DataFrame:
    """Replace the window struct by zone-less start and end columns, and round the sum."""
    keys = [c for c in windowed.columns if c not in (name, *MEASURES)]
    return windowed.select(
        *keys,
        F.col(f"{name}.start").cast("timestamp_ntz").alias("window_start"),
        F.col(f"{name}.end").cast("timestamp_ntz").alias("window_end"),
        "n_events", F.col("total_value").cast(TOTAL).alias("total_value"),
    )


def tumbling(events: DataFrame, size: str = "1 hour") -> DataFrame:
    return flat(events.groupBy(F.window("ts", size), "event_type").agg(*measures()))


def whole_multiple(events: DataFrame, size: str, slide: str) -> bool:
    """Whether a duration is a whole multiple of another; both as windows take them."""
    epoch = F.timestamp_seconds(F.lit(0))
    lengths = [F.unix_micros(epoch + F.expr(f"interval {d}")) for d in (size, slide)]
    whole, part = events.sparkSession.range(1).select(*lengths).first()
    return whole % part == 0


def sliding(events: DataFrame, size: str = "1 hour", slide: str = "15 minutes") -> DataFrame:
    """Overlapping windows.

    If size is a whole multiple of slide, events are summed into slide-long panes first, so
    only the few pane rows are copied into the windows that overlap them, not every event.
    Windows of other sizes begin or end inside a pane, so there every event is copied.
    """
    if not whole_multiple(events, size, slide):
        return flat(events.groupBy(F.window("ts", size, slide), "event_type").agg(*measures()))
    panes = events.groupBy(F.window("ts", slide).alias("pane"), "event_type").agg(*measures())
    windows = panes.select(
        F.window("pane.start", size, slide).alias("window"), "event_type", *MEASURES
    )
    return flat(
        windows.groupBy("window", "event_type").agg(
            F.sum("n_events").alias("n_events"), F.sum("total_value").alias("total_value"),
        )
    )


def sessions(events: DataFrame, gap: str = "30 minutes", slice_by: str = "hour") -> DataFrame:
    """Runs of a user's events in which each follows the last by at most the gap.

    A user's timeline is cut into slices, so a very busy user is spread over many
    tasks. Sessions are found within each slice; of those only the first and last can
    continue in a neighbouring slice, so at most two rows per user and slice meet in the
    second pass, which joins them up. The others pass through it slice by slice. Events
    without a user have no sessions.
    """
    pause = F.expr(f"interval {gap}")
    e = events.where(F.col("user_id").isNotNull()).select(
        "user_id", F.col("ts").cast("timestamp_ntz").alias("ts"), measured(F.col("value")).alias("value")
    ).withColumn("slice", F.date_trunc(slice_by, "ts"))

    in_slice = Window.partitionBy("user_id", "slice").orderBy("ts")
    before = F.lag("ts").over(in_slice)
    begins = F.when(before.isNull() | (F.col("ts") > before + pause), 1).otherwise(0)
    pieces = (
        e.withColumn("begins", begins)
        .withColumn("piece", F.sum("begins").over(in_slice.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy("user_id", "slice", "piece")
        .agg(
            F.min("ts").alias("first"), F.max("ts").alias("last"),
            F.count(F.lit(1)).alias("n_events"), F.sum("value").alias("total_value"),
        )
        .withColumn("pieces", F.max("piece").over(Window.partitionBy("user_id", "slice")))
        .withColumn("inside", F.when((F.col("piece") > 1) & (F.col("piece") < F.col("pieces")), F.col("slice")))
    )
    by_time = Window.partitionBy("user_id", "inside").orderBy("first")
    ended = F.lag("last").over(by_time)
    opens = F.when(ended.isNull() | (F.col("first") > ended + pause), 1).otherwise(0)
    return (
        pieces.withColumn("opens", opens)
        .withColumn("nth", F.sum("opens").over(by_time.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy("user_id", "inside", "nth")
        .agg(
            F.min("first").alias("session_start"),
            (F.max("last") + pause).alias("session_end"),
            F.sum("n_events").alias("n_events"),
            F.sum("total_value").cast(TOTAL).alias("total_value"),
        )
        .drop("inside", "nth")
    )
