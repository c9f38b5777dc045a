"""Reading what is new since a checkpoint, with an overlap for late rows."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The start of time for a first run, and the overlap.
EPOCH = datetime(1970, 1, 1)
LATE_WINDOW = timedelta(days=2)

INCREMENT_COLUMNS = ["id", "id_cliente", "data_hora", "metodo_pagamento", "version_timestamp"]


def increment_since(
    transacoes: DataFrame, since: datetime, late: timedelta = LATE_WINDOW,
    columns: list[str] | None = None,
) -> DataFrame:
    """Rows at or after since - late. The bound is a literal, so scans skip by statistics."""
    bound = F.lit(since - late).cast("timestamp_ntz")
    wanted = [c for c in (columns or INCREMENT_COLUMNS) if c in transacoes.columns]
    return transacoes.where(F.col("data_hora") >= bound).select(*wanted)


def next_checkpoint(increment: DataFrame, last: datetime) -> DataFrame:
    """One row: the latest event time seen, never before the last checkpoint."""
    latest = F.max(F.col("data_hora").cast("timestamp_ntz"))
    held = F.lit(last).cast("timestamp_ntz")
    return increment.agg(F.greatest(latest, held).alias("last_processed"))
