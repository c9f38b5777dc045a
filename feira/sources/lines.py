"""Numbered lines of text files that are read in parallel.

A file is read in splits, by many tasks. A first pass counts the lines of each split; their sums,
split after split, say with which number each split begins, and a second pass adds the place
inside the split. Both passes read the same splits in the same order, and a line whose split the
first pass did not see stops the job. A file may also be a folder of pieces, as many tasks write
one; then the numbers run on from piece to piece.
"""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from feira.sources.files import CORRUPT, DIALECT, missing_as_file_not_found, read_header

FILE, LINE = "_ficheiro", "_linha"


def _read_lines(spark: SparkSession, path: str) -> DataFrame:
    with missing_as_file_not_found():
        return spark.read.text(path)


def numbered_lines(spark: SparkSession, path: str, pieces: bool = False) -> DataFrame:
    """(_ficheiro, _linha, value): the lines of the files at path that are not empty, numbered
    from 1 in each file. With pieces, the files of a folder, by name, are one file, which is
    called by the folder, a slash at its end."""
    at = F.col("_metadata.file_path")
    lines = _read_lines(spark, path).select(
        "value", at.alias("_piece"), F.col("_metadata.file_block_start").alias("_split")
    ).where(~F.col("value").isin("", "\r")).withColumn("_place", F.monotonically_increasing_id())
    file = F.regexp_extract("_piece", "^(.*/)", 1) if pieces else F.col("_piece")
    splits = lines.groupBy("_piece", "_split").agg(F.count(F.lit(1)).alias("_n"), F.min("_place").alias("_first"))
    earlier = Window.partitionBy(FILE).orderBy("_piece", "_split").rowsBetween(Window.unboundedPreceding, -1)
    begins = splits.withColumn(FILE, file).select(
        FILE, "_piece", "_split", "_first", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before")
    )
    number = F.coalesce(F.col("_before") + F.col("_place") - F.col("_first") + 1, F.raise_error(F.lit("a split was not counted")))
    # One row of each split, so that the lines need not be shuffled.
    return lines.join(F.broadcast(begins), ["_piece", "_split"], "left").select(FILE, number.alias(LINE), "value")


def read_numbered_csv(spark: SparkSession, path: str, pieces: bool = False) -> DataFrame:
    """Every field of headed CSV files as text, by the files' own header, with the file and the
    number of each row in it, from 1. Lines that do not have as many fields as the header are
    kept and marked. Empty lines do not count; fields hold no line ends. With pieces, see
    numbered_lines, only the first piece of a file is headed."""
    first = unquote(min(_read_lines(spark, path).inputFiles(), default=path)) if pieces else path
    header = read_header(spark, first)
    fields = ", ".join(f"`{c}` string" for c in [*header, CORRUPT])
    options = {
        **{k: str(v).lower() if isinstance(v, bool) else v for k, v in DIALECT.items() if k != "header"},
        "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT,
    }
    rows = numbered_lines(spark, path, pieces).where(F.col(LINE) > 1)
    line = F.regexp_replace("value", "\r$", "")
    parsed = rows.select(
        FILE, (F.col(LINE) - 1).alias(LINE), F.from_csv(line, fields, options).alias("row")
    )
    return parsed.select(FILE, LINE, "row.*")
