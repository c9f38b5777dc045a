"""The product dimension from all its snapshots in one pass, in whatever order they came.

Applying snapshots one by one needs them in order, and a late one cannot be slipped in. Here
the history is a matter of gaps and islands: along the snapshots of an id, one at which its
versions are closed begins a new stretch, and the rows of a stretch that are alike are one version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feira.operators.scd2 import ATTRIBUTES
from feira.schemas import DIM_PRODUCTS, PRICE


def history(snapshots: DataFrame, at: str = "as_of", strict: bool = False) -> DataFrame:
    """What `apply_scd2` makes of the snapshots one after the other, by ascending `at`.

    snapshots has the columns of products and the time of each row's snapshot, which holds an id
    once. With strict any change of an id closes its version. Without, a row is recognised by
    all descriptive columns (one that lacks any never is); a changed price closes all versions
    of the id that are open, others are opened beside those. An id that a snapshot lacks stays
    as it was. Rows without an id are versions of their own, as they meet no other.
    """
    rows = snapshots.select(
        "id", *ATTRIBUTES, F.col("preco").cast(PRICE).alias("preco"), F.col(at).cast("timestamp").alias("_at")
    )
    # Ids that are missing must not meet; they get a number each.
    lone = F.when(F.col("id").isNull(), F.monotonically_increasing_id())
    rows = rows.withColumn("_lone", lone)
    key = ["id", "_lone"]
    nth = F.row_number().over(Window.partitionBy(*key).orderBy("_at"))
    rows = rows.withColumn("_n", nth)
    unknown = F.greatest(*[F.col(c).isNull() for c in ATTRIBUTES])
    if strict:
        before = Window.partitionBy(*key).orderBy("_n")
        values = F.struct(*ATTRIBUTES, "preco")
        last = F.lag(values).over(before)
        rows = rows.withColumn("_resets", (F.col("_n") > 1) & ~values.eqNullSafe(last))
        stretches = Window.partitionBy(*key).orderBy("_n").rowsBetween(Window.unboundedPreceding, 0)
        rows = rows.withColumn("_stretch", F.sum(F.col("_resets").cast("int")).over(stretches))
    else:
        # A row resets its id if the last row like it had another price and was not closed
        # since. That depends on the resets before it: they are found one after the other,
        # among the rows that may be, of which an id has at most as many as snapshots.
        rows = rows.withColumn("_own", F.when(unknown, F.col("_n")))
        alike = Window.partitionBy(*key, *ATTRIBUTES, "_own").orderBy("_n")
        may = ~F.col("preco").eqNullSafe(F.lag("preco").over(alike)) & F.lag("_n").over(alike).isNotNull()
        rows = rows.withColumns({"_like": F.lag("_n").over(alike), "_may": may})
        tried = rows.where("_may").groupBy(*key).agg(F.array_sort(F.collect_list(F.struct("_n", "_like"))).alias("_tried"))
        none = F.array().cast("array<int>")
        found = F.aggregate("_tried", none, lambda resets, x: F.when(
            F.coalesce(F.try_element_at(resets, F.lit(-1)), F.lit(0)) <= x["_like"], F.concat(resets, F.array(x["_n"]))
        ).otherwise(resets))
        # Only ids that are known have rows like others.
        resets = tried.select(F.col("id").alias("_of"), found.alias("_resets_at"))
        rows = rows.join(resets, F.col("id") == F.col("_of"), "left").drop("_of")
        at_reset = F.array_contains("_resets_at", F.col("_n"))
        passed = F.size(F.filter(F.coalesce("_resets_at", none), lambda r: r <= F.col("_n")))
        rows = rows.withColumns({"_resets": F.coalesce(at_reset, F.lit(False)), "_stretch": passed})
    same = [] if strict else [*ATTRIBUTES, "_own"]
    opened = rows.groupBy(*key, "_stretch", *same).agg(
        F.min("_at").alias("start_date"), F.min_by(F.struct(*ATTRIBUTES, "preco"), "_n").alias("_first")
    )
    ends = rows.where("_resets").select(
        *[F.col(k).alias(f"_end_{k}") for k in key], (F.col("_stretch") - 1).alias("_ended"), F.col("_at").alias("end_date")
    )
    # A row without an id is alone and never closed.
    met = (F.col("id") == F.col("_end_id")) & (F.col("_stretch") == F.col("_ended"))
    closed = opened.join(ends, met, "left")
    return closed.select(
        "id", *[F.col(f"_first.{c}").alias(c) for c in (*ATTRIBUTES, "preco")], "start_date", "end_date",
        F.col("end_date").isNull().alias("is_current"),
    ).select(*DIM_PRODUCTS.names)
