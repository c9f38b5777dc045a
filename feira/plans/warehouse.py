"""Build the warehouse: customer value, recommendations, revenue and the product dimension.

All tables of a build become visible together: each is written beside its older versions, and
one appended commit names the build that readers see. What was written is measured by the
writes themselves and kept as data.
"""

from __future__ import annotations

import logging
import time
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feira.operators.copurchase import co_purchases
from feira.operators.fact import order_fact
from feira.operators.metrics import customer_lifetime_value, revenue_over_time
from feira.plans.dimension import next_dimension, read_dimension
from feira.plans.measured import append_metrics, measured_write, read_metrics
from feira.plans.tables import append_commit, committed_version, staged, write_snapshot

log = logging.getLogger(__name__)

DIMENSION = "dim_products"


def build_warehouse(
    transacoes: DataFrame, itens: DataFrame, produtos: DataFrame, root: str,
    as_of: datetime | None = None,
) -> dict[str, int]:
    """Replace the tables under root in one commit; returns the rows written to each.

    The dimension keeps what earlier builds closed and writes the rest. A build that fails
    leaves the last one as it is, and is replaced by the next.
    """
    started = time.monotonic()
    spark = produtos.sparkSession
    orders = staged(order_fact(transacoes, itens, produtos), "order-fact")
    daily = staged(revenue_over_time(orders).daily, "daily")
    # The weekly and monthly tables are rolled up from the few daily rows.
    by_day = revenue_over_time(daily.withColumnRenamed("daily_revenue", "total_linha"))
    lines = itens.select(
        F.col("id_transacao").alias("transaction_id"), F.col("id_produto").alias("product_id")
    )
    last = committed_version(spark, root)
    build = 0 if last is None else last + 1
    outputs = {
        DIMENSION: (next_dimension(produtos, f"{root}/{DIMENSION}", last, as_of), ["is_current"]),
        "dim_customer_value": (customer_lifetime_value(orders), []),
        "fact_recommendations": (co_purchases(lines), []),
        "fact_daily_sales": (daily, []),
        "fact_weekly_sales": (by_day.weekly, []),
        "fact_monthly_sales": (by_day.monthly, []),
    }
    measured = [
        measured_write(df, name, lambda w, name=name, by=by: write_snapshot(w, f"{root}/{name}", build, *by))
        for name, (df, by) in outputs.items()
    ]
    append_metrics(spark, f"{root}/metrics", build, measured)
    append_commit(spark, root, build)
    rows = {m.table_name: m.n_rows for m in measured}
    log.info("warehouse built in %.2fs: %s", time.monotonic() - started, rows)
    return rows


def read_warehouse(spark: SparkSession, root: str, table: str) -> DataFrame | None:
    """A warehouse table as last built; None before the first build."""
    build = committed_version(spark, root)
    if build is None:
        return None
    if table == DIMENSION:
        return read_dimension(spark, f"{root}/{table}", build)
    return spark.read.parquet(f"{root}/{table}/snapshots/version={build}")


def run_metrics(spark: SparkSession, root: str) -> DataFrame | None:
    """(run, table_name, n_rows, nulls, seconds, finished_at) of every committed build; None
    before the first."""
    build = committed_version(spark, root)
    if build is None:
        return None
    # A build that failed may have left rows under a number that a later one took over.
    by_age = F.max_by(F.struct("n_rows", "nulls", "seconds", "finished_at"), "finished_at")
    found = read_metrics(spark, f"{root}/metrics").where(F.col("run") <= build)
    return found.groupBy("run", "table_name").agg(by_age.alias("m")).select("run", "table_name", "m.*")
