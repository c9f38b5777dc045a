"""CSV and Parquet files of the four entities."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feira.schemas import ENTITIES, RAW_HEADERS, conform

CORRUPT = "_corrupt_record"
# One dialect for reading and writing, that of the csv module and pandas: quotes are
# doubled, blanks belong to the field.
DIALECT = {
    "header": True, "quote": '"', "escape": '"',
    "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False,
}


@contextmanager
def missing_as_file_not_found():
    """Report a path no reader can find as FileNotFoundError."""
    try:
        yield
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(e.getMessage()) from None
        raise


def read_raw_csv(
    spark: SparkSession, path: str | list[str], header: list[str], multi_line: bool = False
) -> DataFrame:
    """Every field as text, for the row rules. Malformed lines are kept and marked.

    Fields may hold line ends only with multi_line, which makes each file one task.
    """
    columns = [T.StructField(name, T.StringType()) for name in [*header, CORRUPT]]
    reader = (
        spark.read.schema(T.StructType(columns))
        .options(**DIALECT, multiLine=multi_line)
        .option("enforceSchema", True)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
    )
    with missing_as_file_not_found():
        return reader.csv(path)


def read_header(spark: SparkSession, path: str) -> list[str]:
    """Column names of a headed CSV file, or of the files of a folder; reads one line."""
    with missing_as_file_not_found():
        # Without the columns that folder names would add.
        return spark.read.options(**DIALECT, recursiveFileLookup=True).csv(path).columns


def read_text_csv(
    spark: SparkSession, path: str | list[str], header: list[str] | None = None, *more: Column, multi_line: bool = False
) -> DataFrame:
    """Every field as text, in columns by the files' header (read from path, if not given), and
    more columns, of the file. A line that does not have as many fields as the header raises
    when it is read."""
    header = header or read_header(spark, path)
    raw = read_raw_csv(spark, path, header, multi_line)
    line = F.concat(F.lit("malformed line: "), F.col(CORRUPT))
    first = F.when(F.col(CORRUPT).isNull(), F.col(f"`{header[0]}`")).otherwise(F.raise_error(line))
    return raw.select(first.alias(header[0]), *[F.col(f"`{c}`") for c in header[1:]], *more)


def read_entity_csv(
    spark: SparkSession, path: str, table: str, multi_line: bool = False
) -> DataFrame:
    """One entity file, projected to its table and leniently typed.

    Columns go by the file's header: extra ones are dropped, missing ones raise.
    """
    return conform(read_text_csv(spark, path, multi_line=multi_line), table)


def list_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders right below path, on any file system; none if there is no path."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(folder):
        return []
    return sorted(s.getPath().getName() for s in system.listStatus(folder) if s.isDirectory())


def read_csv_folder(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """All four entities from `<folder>/<table>.csv`; any missing file raises."""
    return {name: read_entity_csv(spark, f"{folder}/{name}.csv", name) for name in ENTITIES}


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).options(**DIALECT).csv(path)


def raw_text(df: DataFrame, table: str) -> DataFrame:
    """An entity frame as the raw file would hold it: header columns, all text."""
    return df.select(*[F.col(c).cast("string").alias(c) for c in RAW_HEADERS[table] if c in df.columns])
