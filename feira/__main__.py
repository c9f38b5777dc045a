"""Command line: python -m feira <job> …  (or spark-submit this file on a cluster)."""

from __future__ import annotations

import argparse
import logging

from pyspark.sql import DataFrame, SparkSession

from feira.plans.incremental import run_incremental
from feira.plans.loader import load_folder
from feira.plans.pipeline import reports, run_pipeline
from feira.plans.quality_gate import run_gate, validate_folder
from feira.plans.tables import read_table
from feira.schemas import ENTITIES
from feira.session import DEFAULTS
from feira.sources.files import raw_text, read_csv_folder, write_csv
from feira.sources.generator import generate


def stored_tables(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    found = {name: read_table(spark, f"{root}/{name}") for name in ENTITIES}
    missing = [name for name, df in found.items() if df is None]
    if missing:
        raise SystemExit(f"not loaded under {root}: {', '.join(missing)}")
    return found


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="feira")
    jobs = p.add_subparsers(dest="job", required=True)

    def job(name: str, **options: object) -> None:
        j = jobs.add_parser(name)
        for option, default in options.items():
            kind = type(default) if default is not None else str
            j.add_argument(f"--{option}", default=default, type=kind, required=default is None)

    job("generate", raw=None, customers=1000, products=500, transactions=5000, seed=0)
    job("validate", raw=None, out=None)
    job("load", raw=None, root=None)
    job("warehouse", environment="dev", raw="", root="", warehouse=None)
    job("incremental", root=None, warehouse=None)
    job("quality", root=None, report=None, environment="dev")
    job("reports", root=None, out=None)
    return p


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    logging.basicConfig(level=logging.INFO, format="%(asctime)s [%(levelname)s] %(message)s")
    builder = SparkSession.builder.appName(f"feira-{args.job}")
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()

    match args.job:
        case "generate":
            made = generate(spark, args.customers, args.products, args.transactions, args.seed)
            for table, df in made.items():
                write_csv(raw_text(df, table), f"{args.raw}/{table}.csv")
        case "validate":
            print(validate_folder(spark, args.raw, args.out))
        case "load":
            load_folder(spark, args.raw, args.root)
            print(f"loaded; audit in {args.root}/audit_loads")
        case "warehouse":
            print(run_pipeline(
                args.environment, args.warehouse,
                csv=lambda: read_csv_folder(spark, args.raw),
                database=lambda: stored_tables(spark, args.root),
            ))
        case "incremental":
            source = stored_tables(spark, args.root)["transacoes"]
            print(run_incremental(
                source, f"{args.warehouse}/fact_transactions_incremental",
                f"{args.warehouse}/checkpoints/transacoes",
            ))
        case "quality":
            run_gate(stored_tables(spark, args.root), args.report, args.environment, args.root)
        case "reports":
            for name, df in reports(stored_tables(spark, args.root)).items():
                write_csv(df, f"{args.out}/{name}")
                print(f"{name}: {args.out}/{name}")


if __name__ == "__main__":
    main()
