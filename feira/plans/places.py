"""Which partitions of a table hold given keys, without reading the table.

For every partition a map of bits says which hashes of keys occur in it. A batch's keys are held
against all maps; partitions whose map says maybe are asked by their key column alone. The maps
only save reading, so that neither equal hashes nor maps that filled up change a result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LEAST_BITS = 1 << 15  # of a partition's map: one row of it
MOST_BITS = 1 << 27
BITS_PER_KEY = 16
MAPS = "part long, bits binary, place string"


def bits_for(rows: int) -> int:
    """The size of maps for partitions of so many rows: a power of two."""
    return min(max(1 << (BITS_PER_KEY * rows).bit_length(), LEAST_BITS), MOST_BITS)


def _bit(key: str, size: int) -> Column:
    return F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(size))


def write_maps(rows: DataFrame, key: str, place: str, size: int, path: str) -> None:
    """The maps of the partitions that rows hold, a folder for each."""
    bit = _bit(key, size)
    rows.groupBy(F.col(place).cast("string").alias("place"), F.bitmap_bucket_number(bit).alias("part")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("bits")
    ).hint("rebalance", "place").write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(
        "place"
    ).parquet(path)


def may_hold(keys: DataFrame, key: str, size: int, spark: SparkSession, path: str, folders: list[str]) -> list[str]:
    """The places, of those with a map in one of the folders, that may hold any of the keys."""
    bit = _bit(key, size)
    wanted = keys.groupBy(F.bitmap_bucket_number(bit).alias("part")).agg(
        F.collect_set(F.bitmap_bit_position(bit).cast("int")).alias("at")  # at most LEAST_BITS
    )
    maps = spark.read.schema(MAPS).option("basePath", path).parquet(*folders)
    # A bit is in byte at / 8 of the map, counted from its lowest end.
    byte = lambda at: F.conv(F.hex(F.substring("bits", F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    is_set = lambda at: F.getbit(byte(at), at % 8) == 1
    hit = maps.join(F.broadcast(wanted) if size == LEAST_BITS else wanted, "part").where(F.exists("at", is_set))
    return [r[0] for r in hit.select("place").distinct().collect()]


def holding(rows: DataFrame, keys: DataFrame, key: str, place: str) -> list[str]:
    """The places of rows that do hold any of the keys."""
    found = rows.select(key, F.col(place).cast("string").alias("place")).join(keys.select(key), key, "left_semi")
    return [r[0] for r in found.select("place").distinct().collect()]
