"""Release of personal rows in groups of at least k that agree in what could identify them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ANY = "*"  # a value that is not told at all
UNKNOWN = "?"  # a value that is missing


def date_levels(day: Column) -> list[Column]:
    """A date from coarse to fine: year, quarter, month, day."""
    quarter = F.concat(F.date_format(day, "yyyy"), F.lit("-Q"), F.quarter(day).cast("string"))
    return [F.date_format(day, "yyyy"), quarter, F.date_format(day, "yyyy-MM"), F.date_format(day, "yyyy-MM-dd")]


def k_anonymous(
    rows: DataFrame, levels: dict[str, list[Column]], k: int, keep: Callable[[DataFrame], DataFrame],
) -> DataFrame:
    """rows with each column of levels told as finely as k allows: every combination of told
    values is that of at least k rows.

    levels names, for each column, its values from coarse to fine, each within the one before.
    All rows begin as one group that tells nothing. In turns, a column is told one level finer in
    every group in which all parts that this makes have k rows or more; a group that cannot be
    parted by one column may still be by the next. Missing values are a value of their own. Fewer
    than k rows in all are not released.

    The search runs on the different combinations and their numbers. keep(df) stores such a
    table and reads it again, so that the rounds do not pile up in one plan.
    """
    if k < 1:
        raise ValueError("k must be positive")
    names = list(levels)
    fine = {
        (c, i): F.coalesce(level.cast("string"), F.lit(UNKNOWN)) for c in names for i, level in enumerate(levels[c], 1)
    }
    columns = {key: f"_{names.index(key[0])}_{key[1]}" for key in fine}
    told = {c: f"_told_{names.index(c)}" for c in names}
    depth = {c: f"_depth_{names.index(c)}" for c in names}
    told_rows = rows.withColumns({columns[key]: value for key, value in fine.items()})
    combos = told_rows.groupBy(*columns.values()).agg(F.count(F.lit(1)).alias("_n"))
    state = keep(combos.withColumns(
        {told[c]: F.lit(ANY) for c in names} | {depth[c]: F.lit(0) for c in names}
    ))
    if (state.agg(F.sum("_n")).first()[0] or 0) < k:
        return rows.limit(0)
    group = [*told.values(), *depth.values()]
    for turn in range(max(map(len, levels.values()))):
        for c in names:
            if turn >= len(levels[c]):
                continue
            finer = F.element_at(F.array(*[F.col(columns[c, i + 1]) for i in range(len(levels[c]))]), F.col(depth[c]) + 1)
            open_ = state.where(F.col(depth[c]) < len(levels[c])).withColumn("_finer", finer)
            parts = open_.groupBy(*group, "_finer").agg(F.sum("_n").alias("_part"))
            smallest = parts.groupBy(*group).agg(F.min("_part").alias("_least"))
            met = state.join(smallest, group, "left")
            fits = F.coalesce(F.col("_least") >= k, F.lit(False))
            state = keep(met.withColumns({
                told[c]: F.when(fits, finer).otherwise(F.col(told[c])),
                depth[c]: F.when(fits, F.col(depth[c]) + 1).otherwise(F.col(depth[c])),
            }).drop("_least"))
    found = told_rows.join(state.select(*columns.values(), *told.values()), list(columns.values()))
    return found.select(*[F.col(told[c]).alias(c) if c in names else F.col(f"`{c}`") for c in rows.columns])
