"""Products bought together."""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Baskets with more distinct products than this are cut into blocks of about this size.
BLOCK = 500
# Products in more orders than this are counted in several tasks.
HOT = 200_000
# Lines and pairs of lines that a task is given, about.
TASK_ROWS = 500_000
MOST_TASKS = 20_000
# Slots of orders in a task: pairs are combined in each before they are shuffled.
SLOTS = 16


class Work(NamedTuple):
    tasks: int
    most: int  # lines of an order


def _work(fact: DataFrame) -> Work:
    """How many tasks the lines and pairs of all orders are dealt to, so that a task's memory
    does not grow with the table, and the lines of the largest order."""
    n = F.col("n").cast("double")
    found = fact.where(F.col("product_id").isNotNull()).groupBy("transaction_id").agg(F.count(F.lit(1)).alias("n")).where(
        F.col("transaction_id").isNotNull()
    ).agg(F.sum(n * (n + 1) / 2).alias("rows"), F.max("n").alias("most")).first()
    return Work(min(max(math.ceil((found["rows"] or 0) / TASK_ROWS), 1), MOST_TASKS), found["most"] or 0)


def baskets(fact: DataFrame, tasks: int = 1) -> DataFrame:
    """Distinct (order, product) with the number of lines."""
    return (
        fact.where(F.col("transaction_id").isNotNull() & F.col("product_id").isNotNull())
        .repartition(tasks, "transaction_id", "product_id")
        .groupBy("transaction_id", "product_id")
        .agg(F.count(F.lit(1)).alias("lines"))
    )


def _counted(basket_rows: DataFrame, key: str) -> DataFrame:
    """(key, n): basket rows per key.

    The condition always holds. It keeps `lines` in the plan, which makes its lower part
    equal to that of basket_rows, so that Spark computes and shuffles that part once.
    """
    counts = basket_rows.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.sum("lines").alias("lines"))
    return counts.where(F.col("lines") >= F.col("n")).select(key, "n")


def _in_cells(basket_rows: DataFrame, block: int, work: Work | None = None) -> DataFrame:
    """Place each row in the cells of its basket's block grid.

    A basket of m products has g = ceil(m / block) blocks, and a row of block b goes to
    the cells (min(b, c), max(b, c)) for c < g. Two rows of different blocks share one
    cell, and rows of one block count only in its diagonal cell, so every pair is met
    exactly once and no cell holds more than about two blocks, however large the basket.
    Cells are dealt to slots, and slots to tasks.
    """
    work = work or _work(basket_rows)
    if work.most > block:
        large = _counted(basket_rows, "transaction_id").where(F.col("n") > block).select(
            "transaction_id", F.ceil(F.col("n") / F.lit(block)).cast("int").alias("blocks")
        )
        rows = basket_rows.join(large, "transaction_id", "left").withColumn(
            "blocks", F.coalesce("blocks", F.lit(1))
        )
    else:
        rows = basket_rows.withColumn("blocks", F.lit(1))
    slot = F.pmod(F.xxhash64("transaction_id", "cell_a", "cell_b"), F.lit(work.tasks * SLOTS)).cast("int")
    own = F.pmod(F.xxhash64("product_id"), F.col("blocks")).cast("int")
    return (
        rows.withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            "transaction_id",
            F.least("own", "other").alias("cell_a"),
            F.greatest("own", "other").alias("cell_b"),
            "own", "product_id", "lines",
        )
        .withColumn("slot", slot)
        .repartition(work.tasks, "slot")
    )


def product_pairs(fact: DataFrame, block: int = BLOCK) -> DataFrame:
    """Each unordered pair once (x < y): line-pair count and number of shared orders.

    Pairs go from the cells into an aggregate of their slot, without a shuffle; only the sums
    of slots are shuffled.
    """
    work = _work(fact)
    blocks = _blocks(_in_cells(baskets(fact, work.tasks), block, work))
    each = blocks.select("*", F.inline(F.concat("a", "b")).alias("x", "lines_x", "own"))
    of_b = (F.col("own") == F.col("cell_a")) & (F.col("cell_a") != F.col("cell_b"))
    met = each.select(
        "slot", "x", "lines_x", F.inline(F.when(of_b, F.col("b")).otherwise(F.col("a"))).alias("y", "lines_y", "_")
    ).where(F.col("x") < F.col("y"))
    of_slots = met.groupBy("slot", F.col("x").alias("product_id_x"), F.col("y").alias("product_id_y")).agg(
        F.sum(F.col("lines_x") * F.col("lines_y")).alias("n"), F.count(F.lit(1)).alias("orders")
    )
    return of_slots.repartition(work.tasks, "product_id_x", "product_id_y").groupBy("product_id_x", "product_id_y").agg(
        F.sum("n").alias("co_purchase_count"), F.sum("orders").alias("shared_orders")
    )


def _both_ways(pairs: DataFrame) -> DataFrame:
    x, y = F.col("product_id_x"), F.col("product_id_y")
    rest = [c for c in pairs.columns if c not in ("product_id_x", "product_id_y")]
    ways = F.array(F.struct(x.alias("x"), y.alias("y")), F.struct(y.alias("x"), x.alias("y")))
    return pairs.select(F.explode(ways).alias("way"), *rest).select(
        F.col("way.x").alias("product_id_x"), F.col("way.y").alias("product_id_y"), *rest
    )


def co_purchases(fact: DataFrame, block: int = BLOCK) -> DataFrame:
    """Count of line pairs per ordered product pair, in both orders."""
    pairs = product_pairs(fact, block).drop("shared_orders")
    return _both_ways(pairs)


def _blocks(cells: DataFrame) -> DataFrame:
    """The two blocks of each cell as lists (a, b); that of a diagonal cell is a. They meet each
    other; one block, of a diagonal cell, meets itself."""
    entry = F.struct(F.col("product_id").alias("p"), F.col("lines").alias("n"), "own")
    return cells.groupBy("slot", "transaction_id", "cell_a", "cell_b").agg(
        F.collect_list(F.when(F.col("own") == F.col("cell_a"), entry)).alias("a"),
        F.collect_list(F.when(F.col("own") != F.col("cell_a"), entry)).alias("b"),
    )


def _partners(cells: DataFrame) -> DataFrame:
    """(slot, transaction_id, product_id, partners): for each product of a cell the others it
    meets there, with the number of line pairs."""
    blocks = _blocks(cells)

    def side(name: str, of_a: bool) -> Column:
        return F.transform(name, lambda x: F.struct(x["p"].alias("p"), x["n"].alias("n"), F.lit(of_a).alias("of_a")))

    each = blocks.withColumn("x", F.explode(F.concat(side("a", True), side("b", False))))
    # The products of a diagonal cell are all in block a.
    others = F.when(F.col("x.of_a") & (F.col("cell_a") != F.col("cell_b")), F.col("b")).otherwise(F.col("a"))
    partners = F.transform(
        F.filter(others, lambda y: y["p"] != F.col("x.p")),
        lambda y: F.struct(y["p"].alias("y"), (F.col("x.n") * y["n"]).alias("n")),
    )
    return each.select("slot", "transaction_id", F.col("x.p").alias("product_id"), partners.alias("partners")).where(
        F.size("partners") > 0
    )


def recommendations(fact: DataFrame, k: int = 5, block: int = BLOCK, hot: int = HOT) -> DataFrame:
    """The k products most often bought with each product, with support and confidence.

    support: share of all orders with both; confidence: share of x's orders with y.

    Not pairs but whole lists of partners go to the task of a product, one for each of its
    orders and blocks, and are counted there; so of most products only the k best pairs are ever
    shuffled. A product of more than `hot` orders is spread over several tasks, whose counts,
    all of them, are summed before its best are chosen.
    """
    work = _work(fact)
    rows = baskets(fact, work.tasks)
    per_product = _counted(rows, "product_id").withColumnsRenamed(
        {"product_id": "product_id_x", "n": "orders_x"}
    )
    n_orders = _counted(rows, "transaction_id").agg(F.count(F.lit(1)).alias("orders_all"))
    lists = _partners(_in_cells(rows, block, work)).withColumnRenamed("product_id", "product_id_x")
    # At most one for every `hot` basket rows, so the lists are shuffled once, to as many tasks as work has.
    spread = per_product.where(F.col("orders_x") > hot).select(
        "product_id_x", F.ceil(F.col("orders_x") / F.lit(hot)).cast("int").alias("parts")
    )
    dealt = lists.join(F.broadcast(spread), "product_id_x", "left").withColumn(
        "parts", F.coalesce("parts", F.lit(1))
    ).withColumn(
        "part", F.pmod(F.xxhash64("transaction_id"), F.col("parts")).cast("int")
    ).repartition(work.tasks, "product_id_x", "part")
    counted = dealt.select("product_id_x", "part", "parts", F.inline("partners").alias("product_id_y", "n")).groupBy(
        "product_id_x", "part", "parts", "product_id_y"
    ).agg(F.sum("n").alias("co_purchase_count"), F.count(F.lit(1)).alias("shared_orders"))
    best = [F.col("co_purchase_count").desc(), F.col("product_id_y")]
    own = Window.partitionBy("product_id_x", "part").orderBy(*best)
    near = counted.withColumn("place", F.row_number().over(own)).where((F.col("place") <= k) | (F.col("parts") > 1))
    whole = near.repartition(work.tasks, "product_id_x", "product_id_y").groupBy("product_id_x", "product_id_y").agg(
        F.sum("co_purchase_count").alias("co_purchase_count"), F.sum("shared_orders").alias("shared_orders")
    )
    top = whole.withColumn(
        "position", F.row_number().over(Window.partitionBy("product_id_x").orderBy(*best))
    ).where(F.col("position") <= k).join(per_product, "product_id_x")
    return top.select(
        "product_id_x", "position", "product_id_y", "co_purchase_count",
        F.round(F.col("shared_orders") / n_orders.scalar(), 8).alias("support"),
        F.round(F.col("shared_orders") / F.col("orders_x"), 8).alias("confidence"),
    )
