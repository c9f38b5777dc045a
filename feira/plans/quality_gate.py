"""Run the expectation suites, write the report, stop the job on any issue."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from feira.operators.expectations import MESSAGES, SUITES, check_tables
from feira.operators.row_rules import violations
from feira.schemas import RAW_HEADERS
from feira.sources.files import CORRUPT
from feira.sources.lines import FILE, LINE, read_numbered_csv


class DataQualityError(RuntimeError):
    """At least one expectation failed."""


def render_report(results: Iterable[Row], environment: str, source: str, at: datetime | None = None) -> str:
    """Markdown report: lineage, one section per table, total."""
    results = list(results)
    at = at or datetime.now(timezone.utc)
    tables = list(dict.fromkeys(r["tabela"] for r in results))
    lines = [
        "# Data Quality Report", "",
        f"- Generated at: {at:%Y-%m-%d %H:%M:%S}Z",
        f"- Environment: **{environment}**", "",
        "## Lineage",
        f"- Source: {source}",
        f"- Validated tables: {', '.join(tables)}",
        "- Downstream: warehouse tables", "",
        "## Expectations", "",
    ]
    issues = 0
    for table in tables:
        failed = [r for r in results if r["tabela"] == table and r["linhas_falhadas"] > 0]
        issues += len(failed)
        lines.append(f"### {table}")
        lines += [
            f"- ❌ {MESSAGES[r['regra']].format(r['coluna'])} ({r['linhas_falhadas']} rows)" for r in failed
        ] or ["- ✅ No issues found"]
        lines.append("")
    lines.append(f"**Total issues:** {issues}")
    return "\n".join(lines) + "\n"


def run_gate(
    tables: dict[str, DataFrame], report_path: str | None = None,
    environment: str = "dev", source: str = "operational tables", suites=None,
) -> list[Row]:
    """Check all tables; write the report; raise if any rule fails.

    The collected rows are one per rule, whatever the size of the tables.
    """
    suites = SUITES if suites is None else suites
    results = check_tables({name: tables[name] for name in suites}, suites).collect()
    if report_path:
        spark = next(iter(tables.values())).sparkSession
        text = render_report(results, environment, source)
        spark.range(1).select(F.lit(text).alias("value")).write.mode("overwrite").text(report_path)
    failed = [r for r in results if r["linhas_falhadas"] > 0]
    if failed:
        raise DataQualityError(
            f"{len(failed)} issues: " + "; ".join(
                f"{r['tabela']}: {MESSAGES[r['regra']].format(r['coluna'])}" for r in failed
            )
        )
    return results


VIOLATIONS = "tabela string, ficheiro string, linha long, chave string, regra string, coluna string, valor string"


def file_violations(spark: SparkSession, path: str, table: str, pieces: bool = False) -> DataFrame:
    """VIOLATIONS of one raw file, or of all files of a folder, with the number of the row in
    its file, from 1 below the header.

    Fields go by the file's own header; a column that it lacks is empty throughout. A line that
    has more or fewer fields than the header is a violation with the line as value, beside those
    of the fields that it lacks. With pieces, the files of a folder, by name, are one file.
    """
    raw = read_numbered_csv(spark, path, pieces)
    lacking = {c: F.lit(None).cast("string") for c in RAW_HEADERS[table] if c not in raw.columns}
    return violations(
        table, raw.withColumns(lacking), place={FILE: "ficheiro", LINE: "linha"}, malformed=CORRUPT
    )


def validate_folder(spark: SparkSession, folder: str, out: str, pieces: bool = False) -> dict[str, str]:
    """Write the row violations of every raw file; returns a status per file.

    A missing file is reported and does not stop the others. For pieces see `file_violations`.
    """
    status, found = {}, spark.createDataFrame([], VIOLATIONS)
    for table in RAW_HEADERS:
        file = f"{table}.csv"
        try:
            found = found.unionByName(file_violations(spark, f"{folder}/{file}", table, pieces))
            status[file] = "finished"
        except FileNotFoundError:
            status[file] = "not found"
    found.write.mode("overwrite").parquet(out)
    return status
