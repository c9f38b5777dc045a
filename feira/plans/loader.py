"""Load raw entity files into the operational tables, with an audit trail."""

from __future__ import annotations

import logging
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feira.operators.merge import DuplicateKeyError
from feira.plans.tables import merge_into, read_table, staged
from feira.schemas import AUDIT, ENTITIES, conform
from feira.sources.files import read_entity_csv

log = logging.getLogger(__name__)


UNIQUE = {"clientes": ["email"]}  # columns besides the id whose values do not repeat


class RejectedBatchError(DuplicateKeyError):
    """A batch breaks the rules of its table."""


class LoadError(RuntimeError):
    """At least one table failed; the audit table says which and why."""


def problems(batch: DataFrame, table: str, held: DataFrame | None = None) -> tuple[int, list[str]]:
    """(rows, what keeps a batch out of its table): repeated ids, values that are missing or do
    not parse (only dates may fail to parse before that, and then they are missing), and values
    of a unique column that repeat in the batch or in rows that it leaves as they are."""
    columns = [f.name for f in ENTITIES[table] if f.name in batch.columns]
    missing = [F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in columns]
    # One shuffle, of sums for each id, counts all.
    per_id = batch.groupBy("id").agg(F.count(F.lit(1)).alias("n"), *missing)
    counts = per_id.agg(
        F.sum("n").alias("n"), F.max("n").alias("most"), *[F.sum(f"null_{c}").alias(c) for c in columns]
    ).first()
    if not counts["n"]:
        return 0, []
    found = [
        f"{c}: {counts[c]} values are missing or no {ENTITIES[table][c].dataType.simpleString()}"
        for c in columns if counts[c]
    ]
    if counts["most"] > 1:
        found.append("id: ids must be unique in a batch")
    for column in UNIQUE.get(table, []):
        all_rows = batch.select("id", column)
        if held is not None:
            stay = held.join(batch.select("id"), "id", "left_anti")
            all_rows = all_rows.unionByName(stay.select("id", column))
        repeated = all_rows.where(F.col(column).isNotNull()).groupBy(column).agg(
            F.count(F.lit(1)).alias("n")
        ).where("n > 1").count()
        if repeated:
            found.append(f"{column}: {repeated} values repeat")
    return counts["n"], found


def load_table(
    batch: DataFrame, table: str, root: str, at: datetime | None = None,
    buckets: int | None = None,
) -> int:
    """Upsert a batch into `<root>/<table>` and return its row count; an empty one does nothing.

    The batch is staged once, so that checks and merge see the same rows. One that breaks
    a rule of the table raises before anything is written. Every row gets a new
    version_timestamp, changed or not. Only the key buckets that the batch touches are
    rewritten.
    """
    spark = batch.sparkSession
    batch = staged(batch, f"batch-{table}")
    held = read_table(spark, f"{root}/{table}") if table in UNIQUE else None
    rows, broken = problems(batch, table, held)
    if not rows:
        return 0
    if broken:
        raise RejectedBatchError(f"{table}: " + "; ".join(broken))
    stamp = F.lit(at or datetime.now(timezone.utc)).cast("timestamp")
    # The ids were found to be unique.
    merge_into(
        batch.withColumn("version_timestamp", stamp), f"{root}/{table}", buckets=buckets, dedupe=None
    )
    return rows


def append_audit(spark: SparkSession, root: str, table: str, file: str, start: datetime,
                 rows: int, error: str | None) -> None:
    values = (table, file, start, datetime.now(timezone.utc), rows, error is None, error)
    row = spark.range(1).select(
        *[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(values, AUDIT.fields)]
    )
    row.coalesce(1).write.mode("append").parquet(f"{root}/audit_loads")


def load_all(
    spark: SparkSession, sources: dict[str, Callable[[], DataFrame]], root: str,
    at: datetime | None = None, files: dict[str, str] | None = None,
) -> DataFrame:
    """Load every table, each on its own: one failing does not stop the others.

    Every attempt leaves an audit row. Once all were tried, any failure raises.
    """
    failed = []
    for table, source in sources.items():
        start = datetime.now(timezone.utc)
        file = (files or {}).get(table, f"{table}.csv")
        try:
            rows = load_table(conform(source(), table), table, root, at)
            append_audit(spark, root, table, file, start, rows, None)
        except Exception as e:
            log.exception("loading %s failed", table)
            failed.append(table)
            append_audit(spark, root, table, file, start, 0, str(e))
    if failed:
        raise LoadError(f"failed tables: {', '.join(failed)}")
    return read_audit(spark, root)


def read_audit(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(AUDIT).parquet(f"{root}/audit_loads")


def load_folder(spark: SparkSession, folder: str, root: str) -> DataFrame:
    """load_all over `<folder>/<table>.csv`."""
    def reader(table: str) -> Callable[[], DataFrame]:
        return lambda: read_entity_csv(spark, f"{folder}/{table}.csv", table)

    return load_all(spark, {table: reader(table) for table in ENTITIES}, root)
