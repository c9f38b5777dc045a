from collections import Counter

import brute
import numpy as np
import pyarrow as pa
import pytest

from feira.llm import quality as Q
from feira.llm.queries import QUERIES
from feira.llm.text import slices

ODD = [None, "", " \n ", "One, two; two. THREE!!\nOne, two; two. three!!\n\n4 5 6 — ñandú", "a " * 5000, "$$$", "x" * 50_000]


def plain(text):
    """The statistics one by one."""
    text = text or ""
    w = brute.words(text)
    if not w:
        return dict.fromkeys(Q.STATISTICS, 0.0)
    lines = [tuple(x) for x in map(brute.words, text.split("\n")) if x]
    pairs = list(zip(w, w[1:]))
    raw = text.encode()
    letters = sum(48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122 or b >= 128 for b in raw)
    out = {
        "words": len(w), "word_bytes": sum(len(x.encode()) for x in w) / len(w),
        "longest_word": max(len(x.encode()) for x in w), "distinct_words": len(set(w)) / len(w),
        "repeated_words": sum(a == b for a, b in pairs) / len(w),
        "distinct_pairs": len(set(pairs)) / max(len(pairs), 1), "lines": len(lines),
        "line_words": len(w) / len(lines), "distinct_lines": len(set(lines)) / len(lines),
    }
    counts = Counter(raw)
    return out | {name: sum(counts[b] for b in codes) / letters for name, codes in Q._CODES.items()}


def test_statistics():
    for size in (1, 100, 1 << 17):
        rows = np.concatenate([Q.statistics_of(d, o) for _, _, d, o in slices(pa.array(ODD, pa.string()), size)])
        for got, text in zip(rows, ODD):
            assert dict(zip(Q.STATISTICS, got)) == pytest.approx(plain(text))


def sample(n=600, seed=3):
    rng = np.random.default_rng(seed)
    x = rng.random((n, len(Q.STATISTICS)))
    y = ((x[:, 0] > 0.4) & (x[:, 3] <= 0.7)).astype(int)
    y[rng.random(n) < 0.03] ^= 1
    return x, y, rng.uniform(0.5, 2, n)


def test_split_is_the_best_of_all():
    x, y, weight = sample(80)
    unit, cuts = weight / weight.sum(), Q.candidates(x)
    gradient, curvature = unit * (0.5 - y), unit * 0.25
    nodes = Q.grow(x, cuts, gradient, curvature, unit)
    gains = {}
    for s, bounds in enumerate(cuts):
        for b in bounds:
            below = x[:, s] <= b
            if min(unit[below].sum(), unit[~below].sum()) >= Q.LEAST:
                gains[s, b] = sum(gradient[m].sum() ** 2 / (curvature[m].sum() + 1e-3) for m in (below, ~below))
    (s, (low, high)), = nodes[1][0].items()
    assert (s, high) == max(gains, key=gains.get) and low == -np.inf


def test_rules_are_paths():
    x, y, weight = sample()
    for rule in Q.boosted_rules(x, y, weight):
        assert 1 <= len(rule) <= Q.DEPTH
        assert len({s for s, _, _ in rule}) == len(rule) and 0 < Q.holds(rule, x).mean() < 1


def test_lasso_meets_its_conditions():
    x, y, weight = sample()
    a = np.column_stack([x, np.ones(len(x))])
    unit = weight / weight.sum()
    for penalty in (0.05, 0.01):
        b = np.zeros(a.shape[1])
        for _ in range(40):
            b = Q.lasso(a, y, weight, penalty, b)
        slope = a.T @ (unit * (Q.logistic(a @ b) - y))
        assert abs(slope[-1]) < 1e-4
        for s, v in zip(slope[:-1], b[:-1]):
            assert abs(s + penalty * np.sign(v)) < 1e-4 if v else abs(s) <= penalty + 1e-4
    assert not Q.lasso(a, y, weight, 10.0, np.zeros(a.shape[1]))[:-1].any()


def test_compiled_is_the_model(spark, frame):
    x, y, weight = sample()
    model = Q.fit(x, y, weight)
    assert model.rules and len(Q.described(model)) == len(model.rules)
    df = spark.createDataFrame([(tuple(map(float, r)),) for r in x], "statistics struct<" + ",".join(
        f"{s}: double" for s in Q.STATISTICS) + ">")
    got = [r[0] for r in df.select(Q.compiled(model)).collect()]
    z = model.offset + sum(w * Q.holds(r, x) for r, w in zip(model.rules, model.weights))
    assert got == pytest.approx(Q.logistic(z).tolist())
    assert ((np.array(got) >= 0.5) == y).mean() > 0.93


DOCS = [(k, ("A good text, with words of its own number %d. " % k) * 2 if k % 2 else "BAD!! $$$ bad bad " * 5) for k in range(40)]


def test_odd_rows(spark, frame):
    docs = frame([*DOCS, (40, None), (None, "A good text."), (3, DOCS[3][1]), (41, "x " * 60_000)], "doc_id long, text string")
    labels = spark.createDataFrame(
        [(k, k % 2) for k in range(40)] + [(0, 0), (None, 1), (5, None), (99, 1)], "doc_id long, quality int")
    model = Q.train(docs, labels)
    out = Q.score(docs, model)
    assert out.columns == [c for c in docs.columns if c not in ("text", "score")] + ["score"]
    scores = [(r["doc_id"], r["score"]) for r in out.collect()]
    assert len(scores) == 44 and all(0 <= s <= 1 for _, s in scores)
    assert all((s >= 0.5) == k % 2 for k, s in scores if k is not None and k < 40)
    assert Q.score(docs.limit(0), model).collect() == []


@pytest.mark.parametrize("rows, want", [([], 0.5), ([(1, 1)], 1.0), ([(1, 0), (2, 0)], 0.0), ([(98, 0), (99, 1)], 0.5)])
def test_nothing_to_learn(spark, frame, rows, want):
    docs = frame(DOCS[:3], "doc_id long, text string")
    model = Q.train(docs, spark.createDataFrame(rows, "doc_id long, quality int"))
    assert [r["score"] for r in Q.score(docs, model).collect()] == pytest.approx([want] * 3, abs=1e-5)


def test_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    rows = QUERIES["op12_quality_rules"](spark, sf).join(
        spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out").collect()
    good = [r["predicted"] for r in rows if r["quality"] == 1]
    bad = [r["predicted"] for r in rows if r["quality"] == 0]
    assert np.mean(good) >= 0.97 and np.mean(bad) <= 0.2


def test_text_is_all_that_a_score_sees(spark):
    docs = spark.createDataFrame([(k, t) for k in (1, 2) for _, t in DOCS], "doc_id long, text string")
    model = Q.train(docs, spark.createDataFrame([], "doc_id long, quality int"))
    assert {r["score"] for r in Q.score(docs, model).collect()} == {0.5}
