"""Latest-version dedupe and upsert as pure functions: (target, batch) -> new target."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


class DuplicateKeyError(ValueError):
    """An upsert batch holds one key more than once."""


def latest_version(df: DataFrame, key: str = "id", version: str = "version_timestamp") -> DataFrame:
    """The last version of each key; a NULL version counts as last.

    Equal versions are settled by the other columns, so reruns agree. The row-number
    filter is applied before the shuffle as well, so a key with very many versions
    sends one row per task.
    """
    rest = [F.col(c).desc_nulls_last() for c in df.columns if c not in (key, version)]
    newest_first = Window.partitionBy(key).orderBy(F.col(version).desc_nulls_first(), *rest)
    return df.withColumn("_nth", F.row_number().over(newest_first)).where("_nth = 1").drop("_nth")


def duplicate_keys(df: DataFrame, *key: str) -> DataFrame:
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")


def require_unique(df: DataFrame, *key: str) -> None:
    """Raise before anything is written if a key repeats."""
    found = duplicate_keys(df, *key).limit(3).collect()
    if found:
        shown = [tuple(row[k] for k in key) for row in found]
        raise DuplicateKeyError(f"duplicate {key} in batch, e.g. {shown}")


def upsert(
    target: DataFrame, batch: DataFrame, key: str = "id",
    stamp: Column | None = None, version: str = "version_timestamp", newer_only: bool = False,
    unique: bool = False,
) -> DataFrame:
    """Batch rows replace target rows of the same key; other target rows stay.

    A batch that holds a key twice raises; `unique` says that it was checked or made so.

    stamp, if given, is the version set on every touched row, changed or not. With
    newer_only a batch row replaces a target row only if its version is not older.
    The target is read once and meets only the batch's keys, which Spark broadcasts
    when they are few.
    """
    if not unique:
        require_unique(batch, key)
    if stamp is not None:
        batch = batch.withColumn(version, stamp)
    if newer_only:
        held = target.select(key, F.col(version).alias("_held"))
        batch = (
            batch.join(held, key, "left")
            .where(F.col("_held").isNull() | (F.col(version) >= F.col("_held")))
            .drop("_held")
        )
    kept = target.join(batch.select(key), key, "left_anti")
    return kept.unionByName(batch.select(*target.columns))


def merge_increment(
    target: DataFrame, increment: DataFrame, key: str = "id",
    version: str = "version_timestamp", newer_only: bool = False,
) -> DataFrame:
    """Dedupe the increment, then upsert it. Running it twice changes nothing."""
    latest = latest_version(increment.select(*target.columns), key, version)
    return upsert(target, latest, key, version=version, newer_only=newer_only, unique=True)
