"""Parquet tables that are replaced or merged without readers seeing half a write.

Plain Parquet has neither MERGE nor atomic overwrite. Small tables are written as a new
snapshot and then committed by one appended row. Large facts are partitioned, by the month of
an event, by buckets of their key, or by a column; new versions of the partitions that a batch
touches are written beside the old ones, and one appended commit makes them live. One writer
per table.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feira.functions.calendar import month_label
from feira.operators.merge import latest_version, require_unique, upsert
from feira.plans import places
from feira.session import scratch_path

BUCKET = "key_bucket"
BUCKET_ROWS = 250_000  # of the first batch in a bucket, where its maker names no number of buckets
MOST_BUCKETS = 4096
MONTH = "event_month"
COMMITS = (
    "version long, column string, buckets int, map_bits long, partitions array<struct<value: string, version: long>>"
)


def read_if_there(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame | None:
    """The Parquet data at path, or None if nothing was written there yet."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    try:
        return reader.parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write df to the shared folder and read it back.

    Its several readers then share one computation and one state of the sources, and
    lost executors cost nothing but the tasks they ran.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def committed_version(spark: SparkSession, path: str) -> int | None:
    commits = read_if_there(spark, f"{path}/commits")
    return None if commits is None else commits.agg(F.max("version")).first()[0]


def write_snapshot(df: DataFrame, path: str, version: int, *partition_by: str) -> None:
    """Write df as a snapshot that no reader sees before a commit names it."""
    # Static: a retry must also clear the partitions of an earlier attempt.
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(
        *partition_by
    ).parquet(f"{path}/snapshots/version={version}")


def append_commit(spark: SparkSession, path: str, version: int) -> None:
    commit = spark.range(1).select(
        F.lit(version).cast("bigint").alias("version"), F.current_timestamp().alias("committed_at")
    )
    commit.coalesce(1).write.mode("append").parquet(f"{path}/commits")


def publish(df: DataFrame, path: str, version: int | None = None, *partition_by: str) -> int:
    """Write df as the next snapshot and make it current.

    Readers keep the old snapshot until the commit row is there; a failed write leaves
    no commit and is replaced on retry. A version that is already committed is skipped,
    so a replayed batch does nothing.
    """
    spark = df.sparkSession
    last = committed_version(spark, path)
    if version is None:
        version = 0 if last is None else last + 1
    elif last is not None and version <= last:
        return last
    write_snapshot(df, path, version, *partition_by)
    append_commit(spark, path, version)
    return version


def current(spark: SparkSession, path: str) -> DataFrame | None:
    """The committed snapshot, or None before the first."""
    version = committed_version(spark, path)
    return None if version is None else spark.read.parquet(f"{path}/snapshots/version={version}")


class Live(NamedTuple):
    """What the last commit of a partitioned table says."""

    version: int
    column: str
    buckets: int | None
    map_bits: int | None
    partitions: dict[str, int]  # value of the partition column -> version that holds it


def live(spark: SparkSession, path: str) -> Live | None:
    commits = read_if_there(spark, f"{path}/commits", COMMITS)
    if commits is None:
        return None
    last = commits.orderBy(F.desc("version")).limit(1).first()
    partitions = {p["value"]: p["version"] for p in last["partitions"]}
    return Live(last["version"], last["column"], last["buckets"], last["map_bits"], partitions)


def _read_live(spark: SparkSession, path: str, now: Live | None, values: list[str] | None) -> DataFrame | None:
    chosen = {} if now is None else {
        v: n for v, n in now.partitions.items() if values is None or v in values
    }
    if not chosen:
        return None
    folders = [f"{path}/data/version={n}/{now.column}={v}" for v, n in sorted(chosen.items())]
    return spark.read.option("basePath", f"{path}/data").parquet(*folders).drop("version")


def read_partitions(
    spark: SparkSession, path: str, values: list[str] | None = None
) -> DataFrame | None:
    """The live rows of a partitioned table, of some partitions or all; None if there are none."""
    return _read_live(spark, path, live(spark, path), values)


def replace_partitions(
    df: DataFrame, path: str, column: str, gone: list[str] | None = None, buckets: int | None = None,
    map_bits: int | None = None, beside: Callable[[DataFrame, int], None] | None = None,
    layout: Callable[[DataFrame], DataFrame] | None = None,
) -> None:
    """Replace the partitions that df holds, and drop those in gone (None: all others).

    The rows are written as a new version beside the old ones; then one appended commit
    names the version that holds each partition. Until that commit readers see the old
    state whole, and a write that crashed before it can simply be repeated. The rebalance
    hint lets Spark split a large partition over tasks and merge small ones, by measured
    size; layout(df) deals the rows to files in another way. beside(rows, version) may write
    more about the new rows before the commit.
    """
    spark = df.sparkSession
    now = live(spark, path)
    version = 0 if now is None else now.version + 1
    folder = f"{path}/data/version={version}"
    dealt = df.hint("rebalance", F.col(column)) if layout is None else layout(df)
    dealt.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(column).parquet(folder)
    written = read_if_there(spark, folder)
    if written is not None and column not in written.columns:  # no rows
        written = None
    # One value per partition written, however many rows they hold.
    values = [] if written is None else [
        r[0] for r in written.select(F.col(column).cast("string")).distinct().collect()
    ]
    if beside is not None and values:
        beside(written, version)
    old = {} if now is None or gone is None else {v: n for v, n in now.partitions.items() if v not in gone}
    partitions = [{"value": v, "version": n} for v, n in {**old, **dict.fromkeys(values, version)}.items()]
    commit = spark.createDataFrame([(version, column, buckets, map_bits, partitions)], COMMITS)
    commit.coalesce(1).write.mode("append").parquet(f"{path}/commits")


def merge_into(
    increment: DataFrame, path: str, key: str = "id", version: str = "version_timestamp",
    buckets: int | None = None, newer_only: bool = False, dedupe: bool | None = True, at: Column | None = None,
) -> None:
    """Upsert an increment into a partitioned table, rewriting only the partitions it touches.

    With `at` a row lies in the month of that time; besides the months of the batch those are
    touched in which its keys were so far, which maps of the keys of each month find. So
    a batch of recent events rewrites recent months, however old the table is. Without it a row
    lies in a bucket of its key, and a batch touches the buckets of its keys; their number is
    set when the table is made, and stored with it, as is what the table is partitioned by.
    Replaying after a crash gives the same table, as the merge is idempotent. With dedupe=False a
    batch that holds a key twice is refused; None says that the caller made sure of it.
    """
    spark = increment.sparkSession
    now = live(spark, path)
    column = BUCKET if at is None else MONTH
    if now is not None and now.column != column:
        raise ValueError(f"{path} is partitioned by {now.column}, not {column}")
    if now is not None and buckets not in (None, now.buckets):
        raise ValueError(f"{path} has {now.buckets} buckets, not {buckets}")
    batch = latest_version(increment, key, version) if dedupe else increment
    if dedupe is False:
        require_unique(batch, key)
    if at is None:
        if now is not None:
            buckets = now.buckets
        elif buckets is None:
            buckets = min(max(-(-batch.count() // BUCKET_ROWS), 1), MOST_BUCKETS)
        place = F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(buckets)).cast("int")
        batch = batch.withColumn(BUCKET, place)
    else:
        batch = batch.withColumn(MONTH, F.coalesce(month_label(at), F.lit("undated")))
        if dedupe:
            batch = staged(batch, "merge-batch")  # its keys and months are asked for apart
    # At most as many as there are partitions.
    sizes = {str(r[0]): r["count"] for r in batch.groupBy(column).count().collect()}
    if not sizes:
        return
    touched, map_bits, beside = set(sizes), None, None
    if at is not None:
        map_bits = places.bits_for(max(sizes.values())) if now is None else now.map_bits
        touched |= _places_of(batch, path, key, now)

        def beside(rows: DataFrame, version: int) -> None:
            places.write_maps(rows, key, MONTH, map_bits, f"{path}/places/version={version}")

    target = _read_live(spark, path, now, list(touched))
    target = batch.limit(0) if target is None else target.select(*batch.columns)
    if at is not None:
        target = target.withColumn(MONTH, F.col(MONTH).cast("string"))
    merged = upsert(target, batch, key, version=version, newer_only=newer_only, unique=True)
    replace_partitions(
        merged, path, column, gone=[] if at is None else list(touched), buckets=buckets, map_bits=map_bits, beside=beside
    )


def _places_of(batch: DataFrame, path: str, key: str, now: Live | None) -> set[str]:
    """The live partitions that hold keys of the batch."""
    if now is None or not now.partitions:
        return set()
    spark, root = batch.sparkSession, f"{path}/places"
    folders = [f"{root}/version={n}/place={v}" for v, n in sorted(now.partitions.items())]
    asked = places.may_hold(batch, key, now.map_bits, spark, root, folders)
    rows = _read_live(spark, path, now, asked) if asked else None
    return set() if rows is None else set(places.holding(rows, batch, key, now.column))


def read_table(spark: SparkSession, path: str) -> DataFrame | None:
    df = read_partitions(spark, path)
    return None if df is None else df.drop(BUCKET, MONTH)
