"""The raw landing zone: raw/year=YYYY/month=MM/day=DD/<entity>/<version>/…

Works on any file system Spark can reach (s3a://, hdfs://, file:).
"""

from __future__ import annotations

from datetime import date, datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feira.schemas import MissingColumnsError
from feira.sources.files import list_folders, read_header, read_text_csv, write_csv

# Folder names of the landed entities, and the version-tag format.
LANDED = {"clientes": "customers", "produtos": "products", "transacoes": "transactions"}
VERSION_FORMAT = "%Y%m%dT%H%M%SZ"


def partition_path(day: date) -> str:
    return f"raw/year={day.year:04d}/month={day.month:02d}/day={day.day:02d}"


def partition_path_column(day: Column) -> Column:
    return F.date_format(day, "'raw/year='yyyy'/month='MM'/day='dd")


def version_tag(at: datetime | None = None) -> str:
    return (at or datetime.now(timezone.utc)).strftime(VERSION_FORMAT)


def entity_path(root: str, day: date, table: str) -> str:
    return f"{root}/{partition_path(day)}/{LANDED[table]}"


def land(tables: dict[str, DataFrame], root: str, day: date, version: str | None = None,
         source: str = "feira") -> str:
    """Write each entity as a new version of the day; earlier versions stay readable."""
    version = version or version_tag()
    for name in LANDED:
        if name not in tables:
            raise FileNotFoundError(f"no data for {name}")
        # A partition folder per version: retrying a version replaces it, never doubles it.
        write_csv(
            tables[name].withColumn("source", F.lit(source)),
            f"{entity_path(root, day, name)}/version={version}",
        )
    return version


def read_landed(
    spark: SparkSession, root: str, day: date, table: str, columns: list[str], pick: str = "last"
) -> DataFrame:
    """One entity of one day, all text: its newest version, or the oldest with pick='first'.

    Columns go by the header of that version, in whatever order it has them; missing ones
    raise. Only the folders of the versions are listed to choose one.
    """
    folder = entity_path(root, day, table)
    found = [f.removeprefix("version=") for f in list_folders(spark, folder) if f.startswith("version=")]
    if not found:
        raise FileNotFoundError(f"no landed version under {folder}")
    wanted = {"last": max, "first": min}[pick](found)
    chosen = read_text_csv(spark, f"{folder}/version={wanted}")
    missing = sorted(set(columns) - set(chosen.columns))
    if missing:
        raise MissingColumnsError(f"{table}: missing required columns {missing}")
    return chosen.select(*columns)


def read_landed_day(
    spark: SparkSession, root: str, day: date, headers: dict[str, list[str]], pick: str = "last"
) -> dict[str, DataFrame]:
    return {name: read_landed(spark, root, day, name, headers[name], pick) for name in LANDED}


def landed_versions(spark: SparkSession, root: str, table: str, columns: list[str]) -> DataFrame:
    """All versions of an entity that ever landed, all text, with the time of each as
    `landed_at`. Columns go by the header of each version."""
    found: dict[tuple[str, ...], list[str]] = {}  # header -> folders
    for year in list_folders(spark, f"{root}/raw"):
        for month in list_folders(spark, f"{root}/raw/{year}"):
            for day in list_folders(spark, f"{root}/raw/{year}/{month}"):
                folder = f"{root}/raw/{year}/{month}/{day}/{LANDED[table]}"
                for version in list_folders(spark, folder):
                    header = tuple(read_header(spark, f"{folder}/{version}"))
                    found.setdefault(header, []).append(f"{folder}/{version}")
    if not found:
        raise FileNotFoundError(f"no landed version of {table} under {root}")
    rows = None
    tag = F.regexp_extract("_metadata.file_path", "/version=([^/]+)/", 1)
    for header, folders in found.items():
        missing = sorted(set(columns) - set(header))
        if missing:
            raise MissingColumnsError(f"{table}: missing required columns {missing}")
        one = read_text_csv(spark, folders, list(header), F.to_timestamp_ntz(tag, F.lit("yyyyMMdd'T'HHmmss'Z'")).alias("landed_at"))
        one = one.select(*columns, "landed_at")
        rows = one if rows is None else rows.unionByName(one)
    return rows
