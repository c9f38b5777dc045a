"""The whole batch run, and the business reports as views."""

from __future__ import annotations

import logging
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame

from feira.operators import analytics
from feira.plans.warehouse import build_warehouse
from feira.sources.selection import select_fact_source

log = logging.getLogger(__name__)

Tables = dict[str, DataFrame]


def run_pipeline(
    environment: str, root: str,
    csv: Callable[[], Tables], database: Callable[[], Tables],
    landed: Callable[[], Tables] | None = None, as_of: datetime | None = None,
) -> dict[str, int]:
    """Pick the environment's source and build the warehouse from it.

    Only the chosen source is opened. The landing zone is optional: if it cannot be
    read, that is logged and the run goes on.
    """
    in_dev = environment.lower() == "dev"
    extra = None
    if landed is not None:
        try:
            extra = landed()
        except Exception as e:
            log.warning("landing zone not read: %s", e)
    chosen = csv() if in_dev else database()
    transacoes, itens, produtos = select_fact_source(environment, chosen, chosen, extra)
    return build_warehouse(transacoes, itens, produtos, root, as_of)


def reports(tables: Tables) -> Tables:
    """The four reports over the operational tables, by name."""
    clientes, produtos = tables["clientes"], tables["produtos"]
    transacoes, itens = tables["transacoes"], tables["transacao_itens"]
    return {
        "top_customers": analytics.top_customers(clientes, transacoes, itens),
        "best_sellers_by_category": analytics.best_sellers(produtos, itens),
        "monthly_revenue_trend": analytics.monthly_trend(transacoes, itens),
        "aov_by_district": analytics.aov_by_district(clientes, transacoes, itens),
    }


def register_reports(tables: Tables) -> list[str]:
    """Make the reports temporary views, so SQL can query them."""
    made = reports(tables)
    for name, df in made.items():
        df.createOrReplaceTempView(name)
    return list(made)
