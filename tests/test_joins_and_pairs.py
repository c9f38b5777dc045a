from collections import Counter
from itertools import permutations
from random import Random

import pytest
from pyspark.sql import functions as F

from feira.operators import copurchase


def brute_force(lines):
    baskets, counts = {}, Counter()
    for order, product in lines:
        baskets.setdefault(order, []).append(product)
    for products in baskets.values():
        counts.update((x, y) for x, y in permutations(products, 2) if x != y)
    return sorted((x, y, n) for (x, y), n in counts.items())


@pytest.mark.parametrize("block", [1, 2, 7, 500])
def test_pairs_equal_brute_force_for_any_block(spark, block):
    r = Random(3)
    lines = [(r.randint(1, 12), r.randint(1, 25)) for _ in range(150)]
    lines += [(99, p) for p in range(60)] + [(99, 5)] * 3  # one basket far over the block
    lines += [(500, 1)]  # a basket of one
    df = spark.createDataFrame(lines, "transaction_id long, product_id long")
    got = sorted(tuple(x) for x in copurchase.co_purchases(df, block).collect())
    assert got == brute_force(lines)


def test_repeated_product_multiplies(spark, rows):
    df = spark.createDataFrame([(1, 10), (1, 10), (1, 20)], "transaction_id long, product_id long")
    assert rows(copurchase.co_purchases(df)) == [(10, 20, 2), (20, 10, 2)]


def test_null_keys_make_no_pairs(spark):
    df = spark.createDataFrame(
        [(None, 10), (None, 20), (1, None), (1, 10)], "transaction_id long, product_id long"
    )
    assert copurchase.co_purchases(df).isEmpty()


def test_cells_stay_small(spark):
    df = spark.range(2000).select(F.lit(1).alias("transaction_id"), F.col("id").alias("product_id"))
    cells = copurchase._in_cells(copurchase.baskets(df), 100).groupBy("cell_a", "cell_b").count()
    assert cells.agg(F.max("count")).first()[0] < 2 * 100 * 1.6


@pytest.mark.parametrize("operator", [copurchase.co_purchases, copurchase.recommendations])
def test_tasks_follow_from_lines_and_pairs(spark, monkeypatch, operator):
    """No task is given more lines and pairs because the table is larger."""
    lines = spark.range(4000).select(
        F.floor(F.col("id") / 4).alias("transaction_id"), F.pmod(F.xxhash64("id"), F.lit(300)).alias("product_id"))
    want = {tuple(r) for r in operator(lines).collect()}
    assert copurchase._work(lines) == (1, 4)
    monkeypatch.setattr(copurchase, "TASK_ROWS", 1000)
    assert copurchase._work(lines) == (10, 4)
    found = operator(lines)
    assert "REPARTITION_BY_NUM" in found._jdf.queryExecution().toString()
    assert {tuple(r) for r in found.collect()} == want


def test_recommendations(spark, rows):
    df = spark.createDataFrame(
        [(1, 1), (1, 2), (2, 1), (2, 2), (3, 1), (3, 3), (4, 4)], "transaction_id long, product_id long"
    )
    got = rows(copurchase.recommendations(df, k=1), "product_id_x", "product_id_y", "support", "confidence")
    assert got == [(1, 2, 0.5, round(2 / 3, 8)), (2, 1, 0.5, 1.0), (3, 1, 0.25, 1.0)]


@pytest.mark.parametrize("block, hot", [(500, 200_000), (3, 4), (1, 1)])
def test_recommendations_equal_counts_of_all_pairs(spark, rows, block, hot):
    """Hot products, baskets of many blocks, ties, repeated lines; however they are dealt."""
    r, k = Random(2), 3
    lines = [(o, r.choice([0, 0, 0, *range(1, 15)])) for o in range(60) for _ in range(r.randint(1, 6))]
    lines += [(99, p) for p in range(30)] + [(98, 7)] * 3 + [(97, 40), (None, 1), (1, None)]
    orders, pairs, shared = {}, Counter(), Counter()
    for o, p in lines:
        if o is not None and p is not None:
            orders.setdefault(o, Counter())[p] += 1
    for basket in orders.values():
        for x, y in permutations(basket, 2):
            pairs[x, y] += basket[x] * basket[y]
            shared[x, y] += 1
    want = []
    for x in {x for x, _ in pairs}:
        n = sum(x in b for b in orders.values())
        ranked = sorted(((-c, y) for (a, y), c in pairs.items() if a == x))[:k]
        want += [(x, i, y, -c, round(shared[x, y] / len(orders), 8), round(shared[x, y] / n, 8)) for i, (c, y) in enumerate(ranked, 1)]
    fact = spark.createDataFrame(lines, "transaction_id long, product_id long")
    assert rows(copurchase.recommendations(fact, k, block, hot)) == sorted(want, key=repr)


def test_recommendations_shuffle_few_pairs(spark):
    """The best of each product and lists of partners, instead of all pairs."""
    lines = spark.range(30_000).select(
        F.floor(F.col("id") / 30).alias("transaction_id"), F.pmod(F.xxhash64("id"), F.lit(400)).alias("product_id"))
    pairs = copurchase.co_purchases(lines).count()
    found = copurchase.recommendations(lines)
    found.collect()
    shuffled = []

    def visit(node):
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            visit(node.executedPlan())
        elif name.endswith("QueryStage"):
            visit(node.plan())
        else:
            if name == "Exchange":
                shuffled.append(node.metrics().get("shuffleRecordsWritten").get().value())
            for i in range(node.children().size()):
                visit(node.children().apply(i))

    # One row for each line, and k for each product; there are many more pairs.
    visit(found._jdf.queryExecution().executedPlan())
    assert pairs > 150_000 and 0 < max(shuffled) <= 30_000


def test_lists_of_partners_are_shuffled_once(spark, monkeypatch):
    """To as many tasks as there is work; a join by product would deal them to a fixed number first."""
    lines = spark.range(3000).select(
        F.floor(F.col("id") / 30).alias("transaction_id"), F.pmod(F.xxhash64("id"), F.lit(400)).alias("product_id"))
    monkeypatch.setattr(copurchase, "TASK_ROWS", 5000)
    name, shuffled = "spark.sql.autoBroadcastJoinThreshold", []
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    try:
        plan = copurchase.recommendations(lines)._jdf.queryExecution().executedPlan()
    finally:
        spark.conf.set(name, before)

    def visit(node):
        if node.nodeName() == "AdaptiveSparkPlan":
            return visit(node.executedPlan())
        if node.nodeName() == "Exchange" and "partners#" in node.output().mkString(","):
            shuffled.append(node.outputPartitioning().toString())
        for i in range(node.children().size()):
            visit(node.children().apply(i))

    visit(plan)
    assert len(shuffled) == 1 and "part#" in shuffled[0]
