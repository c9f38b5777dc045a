"""Versioned customer and product features, and point-in-time lookup."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feira.functions.money import amount, cents
from feira.schemas import TOTAL

FEATURES = ["orders_to_date", "spend_to_date", "last_order"]


def customer_features(orders: DataFrame, feature_version: str = "v1") -> DataFrame:
    """One version per customer and active month, valid from the start of the next month.

    orders has customer_id, data_hora and receita. The running totals are over months,
    not orders, so a customer's rows in the window are bounded by the calendar.
    """
    known = orders.where(F.col("customer_id").isNotNull() & F.col("data_hora").isNotNull())
    months = known.groupBy("customer_id", F.trunc("data_hora", "month").alias("month")).agg(
        F.count(F.lit(1)).alias("orders"),
        F.sum("receita").alias("spend"),
        F.max("data_hora").alias("last_order"),
    )
    by_month = Window.partitionBy("customer_id").orderBy("month")
    so_far = by_month.rowsBetween(Window.unboundedPreceding, 0)
    return months.select(
        "customer_id",
        F.lit(feature_version).alias("feature_version"),
        F.add_months("month", 1).alias("valid_from"),
        F.add_months(F.lead("month").over(by_month), 1).alias("valid_to"),
        F.sum("orders").over(so_far).alias("orders_to_date"),
        F.sum("spend").over(so_far).cast(TOTAL).alias("spend_to_date"),
        F.max("last_order").over(so_far).alias("last_order"),
    )


def trailing_features(
    orders: DataFrame, days: tuple[int, ...] = (30, 90), slice_days: int = 366, feature_version: str = "v1",
) -> DataFrame:
    """Orders and spend of the last so many days, for each customer and day with orders, that
    day included.

    Orders are summed per day first. A customer's days are cut into slices of slice_days, so a
    long history is spread over tasks; a slice also gets the days before it that its own look
    back to, which count there but are not returned.
    """
    back = max(days) - 1
    if slice_days <= back:
        raise ValueError("a slice must be longer than the longest look back")
    known = orders.where(F.col("customer_id").isNotNull() & F.col("data_hora").isNotNull())
    daily = known.groupBy("customer_id", F.to_date("data_hora").alias("day")).agg(
        F.count(F.lit(1)).alias("orders"), F.sum(cents(F.col("receita"))).alias("spend")
    ).withColumn("_n", F.unix_date("day"))
    own = F.floor(F.col("_n") / slice_days)
    reaches = F.floor((F.col("_n") + back) / slice_days)
    dealt = daily.select("*", own.alias("_own"), F.explode(F.array_distinct(F.array(own, reaches))).alias("_slice"))
    line = Window.partitionBy("customer_id", "_slice").orderBy("_n")
    sums = {}
    for n in days:
        last = line.rangeBetween(-(n - 1), 0)
        sums[f"orders_{n}d"] = F.sum("orders").over(last)
        sums[f"spend_{n}d"] = amount(F.sum("spend").over(last))
    found = dealt.withColumns(sums).where("_slice = _own")
    return found.select("customer_id", F.lit(feature_version).alias("feature_version"), "day", *sums)


def product_features(produtos: DataFrame, itens: DataFrame, feature_version: str = "v1") -> DataFrame:
    """Sales features per product; products without sales have zeros."""
    sold = itens.groupBy("id_produto").agg(
        F.count(F.lit(1)).alias("lines"), F.sum(F.col("quantidade").cast("bigint")).alias("units")
    )
    names = produtos.select(F.col("id").alias("id_produto"), "categoria", "preco")
    return names.join(sold, "id_produto", "left").select(
        F.col("id_produto").alias("product_id"),
        F.lit(feature_version).alias("feature_version"),
        "categoria", "preco",
        F.coalesce("lines", F.lit(0)).alias("lines_sold"),
        F.coalesce("units", F.lit(0)).alias("units_sold"),
    )


def as_of(labels: DataFrame, versions: DataFrame, at: str, feature_version: str) -> DataFrame:
    """Each label row with the features of one version that were valid at its time.

    A row of features is valid from valid_from, that instant included, to valid_to, that
    instant not included (NULL: for good). The row that began last counts; of rows that
    began at once, the one that ends last. Labels without valid features, without a customer or without a time have NULLs.

    Labels and features are one timeline of each customer, along which the last row of
    features is carried forward: no range join, and no later knowledge in a row. Customers
    are cut by year, so a busy one is spread over tasks; each year begins with what was
    last known before it.
    """
    time = F.col(at).cast("timestamp_ntz")
    begins = F.col("valid_from").cast("timestamp_ntz")
    known = versions.where((F.col("feature_version") == feature_version) & begins.isNotNull()).select(
        "customer_id", begins.alias("_from"), F.col("valid_to").cast("timestamp_ntz").alias("_to"),
        F.struct("feature_version", "valid_from", *FEATURES).alias("_f"),
    ).withColumn("_year", F.year("_from"))
    # What each year of a customer ends with, for the years after it until the next one.
    ends = known.groupBy("customer_id", "_year").agg(
        F.max(F.struct("_from", F.coalesce("_to", F.lit("9999-12-31").cast("timestamp_ntz")).alias("until"), "_to", "_f")).alias("_end")
    )
    years = labels.select("customer_id", F.year(time).alias("_year")).distinct()
    by_year = Window.partitionBy("customer_id").orderBy("_year", "_is_label")
    before = by_year.rowsBetween(Window.unboundedPreceding, -1)
    openings = ends.withColumn("_is_label", F.lit(1)).unionByName(
        years.where(F.col("customer_id").isNotNull()).withColumn("_is_label", F.lit(0)), allowMissingColumns=True
    ).withColumn("_end", F.last("_end", ignorenulls=True).over(before)).where("_is_label = 0").where(
        "_end is not null"
    ).select("customer_id", "_year", "_end._from", "_end._to", "_end._f")
    events = known.unionByName(openings).withColumn("_label", F.lit(None).cast(labels.schema)).withColumn("_at", F.col("_from"))
    asked = labels.select(
        "customer_id", F.year(time).alias("_year"), F.struct(*[F.col(c) for c in labels.columns]).alias("_label"),
        time.alias("_at"),
    )
    line = events.withColumn("_known", F.struct("_from", "_to", "_f")).unionByName(asked, allowMissingColumns=True)
    last_first = F.coalesce("_to", F.lit("9999-12-31").cast("timestamp_ntz"))
    along = Window.partitionBy("customer_id", "_year").orderBy("_at", F.col("_label").isNotNull(), last_first)
    carried = F.last("_known", ignorenulls=True).over(along.rowsBetween(Window.unboundedPreceding, 0))
    found = line.withColumn("_known", carried).where("_label is not null")
    valid = F.col("customer_id").isNotNull() & (F.col("_known._to").isNull() | (F.col("_at") < F.col("_known._to")))
    return found.select("_label.*", F.when(valid, F.col("_known._f")).alias("_f")).select(*labels.columns, "_f.*")
