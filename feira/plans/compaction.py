"""Small files of a partitioned table put together, and versions that no commit names deleted.

What to compact follows from the files themselves: their number and size in each live partition.
The rows of a partition are laid along a space-filling curve over two columns, so that the
files, and the row groups in them, each cover a small range of both, and a filter on either skips
most. A compaction is a commit like any other: readers see the old files until it is there.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feira.plans import places
from feira.plans.tables import COMMITS, live, read_if_there, read_partitions, replace_partitions
from feira.sources.files import list_folders

TARGET = 128 << 20  # bytes of a file
MOST_ROWS = 2_000_000  # that a task sorts, about, however small they are in files
STEPS = 1 << 15  # of each column along the curve


def file_sizes(spark: SparkSession, path: str) -> DataFrame:
    """(value, files, bytes) of each live partition; no rows are read."""
    now, rows = live(spark, path), read_partitions(spark, path)
    if rows is None:
        return spark.createDataFrame([], "value string, files long, bytes long")
    each = rows.select(
        F.col(now.column).cast("string").alias("value"), F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_size").alias("size"),
    ).distinct()
    return each.groupBy("value").agg(F.count(F.lit(1)).alias("files"), F.sum("size").alias("bytes"))


def worth_compacting(sizes: DataFrame, target: int = TARGET) -> list[str]:
    """Partitions of several files that are small on average: half the target or less."""
    small = (F.col("files") > 1) & (F.col("bytes") <= F.col("files") * (target / 2))
    return sorted(r["value"] for r in sizes.where(small).collect())


def _spread(c: Column) -> Column:
    """The 15 bits of c with a gap behind each."""
    for shift, mask in ((8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555)):
        c = c.bitwiseOR(F.shiftleft(c, shift)).bitwiseAND(F.lit(mask))
    return c


def along_curve(df: DataFrame, x: str, y: str) -> Column:
    """The place of a row on the curve: the bits of where it lies in x and y, in turns.

    x and y are numbers or times; a missing value lies below all others.
    """
    def number(c: str) -> Column:
        kind = df.schema[c].dataType.typeName()
        value = F.unix_micros(F.col(c).cast("timestamp")) if kind in ("date", "timestamp", "timestamp_ntz") else F.col(c)
        return value.cast("double")

    low_high = df.agg(*[f(number(c)).alias(f"{n}_{c}") for c in (x, y) for n, f in (("low", F.min), ("high", F.max))]).first()

    def step(c: str) -> Column:
        low, high = low_high[f"low_{c}"], low_high[f"high_{c}"]
        if low is None or high <= low:
            return F.lit(0)
        at = F.floor((number(c) - low) / (high - low) * (STEPS - 2)).cast("int") + 1
        return F.coalesce(at, F.lit(0))

    return F.shiftleft(_spread(step(x)), 1).bitwiseOR(_spread(step(y)))


def compact(
    spark: SparkSession, path: str, x: str, y: str, target: int = TARGET, key: str = "id",
    values: Iterable[str] | None = None,
) -> list[str]:
    """Rewrite the partitions that are worth it (or the given ones) into files of about the
    target size, or of MOST_ROWS rows if those are smaller, and return their names. The rows stay
    the same."""
    now = live(spark, path)
    sizes = file_sizes(spark, path)
    chosen = worth_compacting(sizes, target) if values is None else sorted(values)
    rows = read_partitions(spark, path, chosen) if chosen else None
    if rows is None:
        return []
    whole = sizes.where(F.col("value").isin(chosen)).agg(F.sum("bytes")).first()[0]
    rows = rows.withColumn(now.column, F.col(now.column).cast("string"))
    curve = along_curve(rows, x, y)
    ranges = max(-(-whole // target), -(-rows.count() // MOST_ROWS), 1)

    def layout(df: DataFrame) -> DataFrame:
        # Ranges of partition and curve, as many as files are wanted: a small partition may
        # share a task, but not a file, with its neighbours.
        ranged = df.withColumn("_curve", curve).repartitionByRange(ranges, now.column, "_curve")
        return ranged.sortWithinPartitions(now.column, "_curve").drop("_curve")

    def beside(written: DataFrame, version: int) -> None:
        places.write_maps(written, key, now.column, now.map_bits, f"{path}/places/version={version}")

    replace_partitions(
        rows, path, now.column, gone=[], buckets=now.buckets, map_bits=now.map_bits,
        beside=beside if now.map_bits else None, layout=layout,
    )
    return chosen


def expire(spark: SparkSession, path: str, keep: int = 2) -> list[str]:
    """Delete partitions that none of the last `keep` commits names, and return their folders.

    Readers that opened the table at one of those commits keep all they may still read; older
    ones must have ended. A folder that is newer than the last commit is left alone, as a
    writer may be at it.
    """
    commits = read_if_there(spark, f"{path}/commits", COMMITS)
    if commits is None:
        return []
    kept = commits.orderBy(F.desc("version")).limit(max(keep, 1)).collect()
    last, column = kept[0]["version"], kept[0]["column"]
    named = {(p["version"], p["value"]) for c in kept for p in c["partitions"]}
    system = spark._jvm.org.apache.hadoop.fs
    gone = []
    for part, prefix in (("data", f"{column}="), ("places", "place=")):
        for folder in list_folders(spark, f"{path}/{part}"):
            version = int(folder.removeprefix("version="))
            held = [f for f in list_folders(spark, f"{path}/{part}/{folder}") if f.startswith(prefix)]
            stale = [f for f in held if (version, f.removeprefix(prefix)) not in named]
            if version > last or not stale:
                continue
            # A version that is gone as a whole goes as a whole.
            names = [folder] if len(stale) == len(held) else [f"{folder}/{f}" for f in stale]
            for name in names:
                old = system.Path(f"{path}/{part}/{name}")
                old.getFileSystem(spark._jsc.hadoopConfiguration()).delete(old, True)
                gone.append(f"{part}/{name}")
    return gone
