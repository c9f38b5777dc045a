import random
import zlib

import numpy as np
import pytest

from feira.llm import toxicity as X
from feira.llm.queries import QUERIES

SCHEMA = "doc_id long, text string, lang string"


def corpus(n=600, seed=1):
    rng = random.Random(seed)
    plain = [f"{a}{b}" for a in "th er on an re he in ed nd ha".split() for b in "es at en or ti is".split()]
    bad = [f"vequ{s}" for s in "er et ir a o um".split()]
    docs, labels = [], []
    for i in range(n):
        w = [rng.choice(plain) for _ in range(rng.randint(20, 80))]
        toxic = i % 5 == 0
        if toxic:
            for _ in range(3):
                w.insert(rng.randrange(len(w)), rng.choice(bad))
        docs.append((i, " ".join(w), rng.choice(["en", "fr"])))
        labels.append((i, int(toxic)))
    return docs, labels


@pytest.fixture(scope="module")
def fitted(spark):
    docs, labels = corpus()
    frame = spark.createDataFrame(docs, SCHEMA)
    given = spark.createDataFrame(labels, "doc_id long, toxic int").where(~X.held_out(X.F.col("doc_id")))
    return X.train(frame, given)


def test_held_out_accuracy(spark, fitted):
    docs, labels = corpus()
    scores = {r.doc_id: r.score for r in X.score(spark.createDataFrame(docs, SCHEMA), fitted).collect()}
    held = [i for i, _ in labels if zlib.crc32(str(i).encode()) % 4 == 2]
    right = [(scores[i] >= X.THRESHOLD) == (dict(labels)[i] == 1) for i in held]
    assert len(held) > 100 and np.mean(right) > 0.97


def test_odd_texts(frame, spark, fitted):
    docs = [(1, None, "en"), (2, "", None), (3, "vequer vequet " * 30000, "xx"), (None, "thes", "fr"), (4, "a", "en"), (4, "a", "en")]
    df = frame(docs, SCHEMA)
    rows = X.score(df, fitted).collect()
    by = {r.doc_id: r.score for r in rows}
    assert len(rows) == len(docs) and by[1] == by[2] and all(0 <= s <= 1 for s in by.values())
    assert by[3] > 0.9
    kept = X.remove_toxic(df, fitted)
    assert kept.columns == df.columns and 3 not in {r.doc_id for r in kept.collect()}
    assert X.score(df.limit(0), fitted).count() == 0


def test_score_sees_text_alone(spark, fitted):
    texts = ["thes vequer vequet", "thes eres"]
    a = X.score(spark.createDataFrame([(1, t, "en") for t in texts], SCHEMA), fitted)
    b = X.score(spark.createDataFrame([(2, t, "fr") for t in texts], SCHEMA), fitted)
    assert [r.score for r in a.collect()] == [r.score for r in b.collect()]


@pytest.mark.parametrize("labels, score", [([], 0.0), ([(1, 0), (2, 0)], 0.0), ([(1, 1)], 1.0), ([(1, None), (None, 1)], 0.0)])
def test_labels_without_both_classes(spark, labels, score):
    docs = spark.createDataFrame([(1, "a b", "en"), (2, None, "en")], SCHEMA)
    model = X.train(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert [r.score for r in X.score(docs, model).collect()] == [score, score]


def test_repeated_and_missing_labels(spark):
    docs, labels = corpus(100)
    frame = spark.createDataFrame([*docs, *docs[:5]], SCHEMA)
    given = spark.createDataFrame([*labels, *labels, (10**6, 1)], "doc_id long, toxic int")
    model = X.train(frame, given)
    assert model.constant is None


def test_all_labelled_rows_are_learnt_from(spark):
    """A word that only the toxic rows of largest hash hold."""
    ids = spark.range(7000).withColumn("toxic", (X.F.col("id") % 2).cast("int"))
    ranked = [(r.id, r.toxic) for r in ids.orderBy(X.F.xxhash64("id"), "id").collect()]
    late = {i for i, _ in [r for r in ranked if r[1]][3000:]}
    rng = random.Random(3)
    docs = []
    for i, toxic in ranked:
        w = [rng.choice("thes eres inat anor hedti nden".split()) for _ in range(12)]
        docs.append((i, " ".join([*w, "molvun" if i in late else "vequer"] if toxic else w), "en"))
    model = X.train(spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(ranked, "doc_id long, toxic int"))
    seen = spark.createDataFrame([(1, "thes inat molvun eres", "en"), (2, "thes inat eres", "en")], SCHEMA)
    scores = {r.doc_id: r.score for r in X.score(seen, model).collect()}
    assert scores[1] > 0.8 and scores[2] < 0.2


def test_long_labelled_texts_are_learnt_from(spark):
    docs = [(i, "thes eres inat " * 20, "en") for i in range(60)]
    docs += [(i, "thes eres inat " * 15_000 + "vequer vequet", "en") for i in range(60, 80)]
    model = X.train(spark.createDataFrame(docs, SCHEMA), spark.createDataFrame([(i, int(i >= 60)) for i in range(80)], "doc_id long, toxic int"))
    assert model.constant is None
    assert [r.score > 0.5 for r in X.score(spark.createDataFrame([docs[0], docs[-1]], SCHEMA), model).orderBy("doc_id").collect()] == [False, True]


def test_buckets_of_all_tasks(spark):
    docs, labels = corpus(90)
    rows = spark.createDataFrame([(t, y) for (_, t, _), (_, y) in zip(docs, labels)], "text string, y int")
    seen = np.zeros((2, X.BUCKETS))
    for (_, t, _), (_, y) in zip(docs, labels):
        data = np.frombuffer(t.encode(), np.uint8)
        seen[y, np.unique(X.buckets(X.words(data, np.array([0, len(data)]))))] += 1
    assert all((X.buckets_seen(rows.repartition(n)) == seen).all() for n in (1, 5))


def test_tasks_change_the_model_together(spark):
    docs, labels = corpus(600)
    rows = spark.createDataFrame([(t, y) for (_, t, _), (_, y) in zip(docs, labels)], "text string, y int").repartition(5)
    model = X.fit(rows, np.array([480.0, 120.0]))
    scores = [r.score for r in X.score(rows.select("y", "text"), model).orderBy("y").collect()]
    assert np.mean([(s >= 0.5) == (i >= 480) for i, s in enumerate(scores)]) > 0.97


def test_slices_do_not_change_scores(fitted):
    import pyarrow as pa

    from feira.llm.text import slices
    texts = pa.array([t for _, t, _ in corpus(40)[0]] + ["", "vequer"])
    whole, parts = (
        np.concatenate([X.score_slice(fitted, d, o) for _, _, d, o in slices(texts, most)]) for most in (1 << 20, 100)
    )
    assert np.allclose(whole, parts, atol=1e-5)


def test_all_documents(spark, sf_dir, table):
    rows = QUERIES["op10_toxicity"](spark, sf_dir).collect()
    assert sorted(r.doc_id for r in rows) == sorted(k for (k,) in table("documents", "doc_id"))
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= X.THRESHOLD)
