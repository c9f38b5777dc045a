"""Type-2 product dimension as a pure function: (dimension, snapshot, as_of) -> dimension."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feira.schemas import DIM_PRODUCTS, PRICE

ATTRIBUTES = ["nome", "categoria", "fornecedor"]


def _open(rows: DataFrame, as_of: Column) -> DataFrame:
    return rows.select(
        "id", *ATTRIBUTES, "preco",
        as_of.alias("start_date"),
        F.lit(None).cast("timestamp").alias("end_date"),
        F.lit(True).alias("is_current"),
    )


def snapshot_of(produtos: DataFrame) -> DataFrame:
    """Source products in dimension types; prices at 2 decimals, as the dimension keeps them."""
    return produtos.select("id", *ATTRIBUTES, F.col("preco").cast(PRICE).alias("preco"))


def initial_dimension(produtos: DataFrame, as_of: Column) -> DataFrame:
    return _open(snapshot_of(produtos), as_of.cast("timestamp"))


def apply_scd2(
    dim: DataFrame, produtos: DataFrame, as_of: Column, strict: bool = False
) -> DataFrame:
    """Close re-priced versions, open their successors, and open unseen products.

    A product is recognised by id and all descriptive columns, so a renamed one is
    opened beside its old version, which stays current. With strict it is recognised by
    id alone and any change closes the old version. Products missing from the snapshot
    stay as they are. An empty dimension needs no special case: every product is unseen.

    Closed versions pass through untouched. Current rows and the snapshot meet once, in one
    shuffle by id: an id has few of either.
    """
    as_of = as_of.cast("timestamp")
    tracked = (ATTRIBUTES if strict else []) + ["preco"]
    match_on = [] if strict else ATTRIBUTES

    held = F.struct(*ATTRIBUTES, "preco", "start_date", "end_date").alias("held")
    seen = F.struct(*ATTRIBUTES, "preco").alias("seen")
    both = dim.where("is_current").select("id", held).unionByName(
        snapshot_of(produtos).select("id", seen), allowMissingColumns=True
    )
    per_id = both.groupBy("id").agg(F.collect_list("held").alias("held"), F.collect_list("seen").alias("seen"))

    def same(h: Column, s: Column) -> Column:
        return reduce(lambda a, c: a & F.coalesce(h[c] == s[c], F.lit(False)), match_on, F.col("id").isNotNull())

    def changed(h: Column, s: Column) -> Column:
        return same(h, s) & reduce(lambda a, c: a | ~h[c].eqNullSafe(s[c]), tracked, F.lit(False))

    closes = F.exists("held", lambda h: F.exists("seen", lambda s: changed(h, s)))
    opens = F.filter("seen", lambda s: ~F.exists("held", lambda h: same(h, s)) | F.exists("held", lambda h: changed(h, s)))
    plain = lambda r: [r[c].alias(c) for c in (*ATTRIBUTES, "preco")]
    kept = F.transform("held", lambda h: F.struct(
        *plain(h), h["start_date"].alias("start_date"),
        F.when(F.col("closes"), as_of).otherwise(h["end_date"]).alias("end_date"), (~F.col("closes")).alias("is_current"),
    ))
    opened = F.transform("opens", lambda s: F.struct(
        *plain(s), as_of.alias("start_date"), F.lit(None).cast("timestamp").alias("end_date"), F.lit(True).alias("is_current"),
    ))
    columns = DIM_PRODUCTS.fieldNames()
    now = per_id.select("id", "held", closes.alias("closes"), opens.alias("opens")).select(
        "id", F.inline(F.concat(kept, opened))
    )
    return dim.where(~F.col("is_current")).select(*columns).unionByName(now.select(*columns))
