import random

import brute
import numpy as np
import pyarrow as pa

from feira.llm import near_duplicates as N
from feira.llm.queries import QUERIES
from feira.llm.text import column_bytes, shingles, words

LETTERS = "a b c d e f g h i j k l m n o p q r s t u v w x y z".split()
DOCS = [
    (1, " ".join(LETTERS)), (2, " ".join(LETTERS).upper()), (3, None), (4, ""), (5, "..."), (6, "one two"),
    (7, "one, two"), (7, "one, two"), (None, " ".join(LETTERS)), (8, " ".join(LETTERS * 200)),
    (9, " ".join(LETTERS * 199)), (10, " ".join(LETTERS + ["zz"])), (None, "alone here"),
    (11, " ".join(LETTERS[:13] + ["X"] + LETTERS[13:])),
]


def family(rng, base, copies, most):
    out = []
    for _ in range(copies):
        w = list(base)
        for _ in range(rng.randint(0, most)):
            w[rng.randrange(len(w))] = f"n{rng.randrange(10**6)}"
        out.append(" ".join(w))
    return out


def classes(df):
    return sorted((tuple(r) for r in N.classes(df).collect()), key=repr)


def test_odd_texts(frame):
    assert classes(frame(DOCS, "doc_id long, text string")) == sorted(brute.near_classes(DOCS), key=repr)


def test_families(frame):
    """Groups of copies of copies with few and many edits, and texts that share a passage."""
    rng = random.Random(5)
    texts = []
    for size in (2, 5, 60):
        base = [f"w{rng.randrange(5000)}" for _ in range(150)]
        texts += family(rng, base, size, 6)
        texts += family(rng, texts[-1].split(), size, 6)
    passage = [f"p{i}" for i in range(60)]
    texts += [" ".join([*passage, *[f"w{rng.randrange(5000)}" for _ in range(40)]]) for _ in range(40)]
    docs = list(enumerate(texts))
    rng.shuffle(docs)
    got = classes(frame(docs, "doc_id long, text string"))
    want = sorted(brute.near_classes(docs), key=repr)
    assert len({c for _, c in want}) > 40
    assert sum(g == w for g, w in zip(got, want)) >= 0.98 * len(want)


def test_registers_agree_as_often_as_documents_are_alike():
    base = [f"w{i}" for i in range(400)]
    other = base[:340] + [f"x{i}" for i in range(60)]
    texts = [" ".join(base), " ".join(other)]
    data, offsets = column_bytes(pa.array(texts))
    s = N.signatures(*N.weighted(*shingles(words(data, offsets), 5)), 2, 4096)
    exact = brute.jaccard(*map(brute.shingles, texts))
    assert abs((s[0] == s[1]).mean() - exact) < 0.04


def test_half_of_a_text_repeated(frame):
    """Sets that are nearly equal are found however often one text repeats a part of its own."""
    docs = []
    for i, times in enumerate([2, 5, 10, 50] * 5):
        half, rest = (" ".join(f"{side}{i}x{k}" for k in range(150)) for side in "ab")
        docs += [(2 * i, f"{half} {rest}"), (2 * i + 1, f"{half} " * times + rest)]
    got = classes(frame(docs, "doc_id long, text string"))
    assert got == sorted(brute.near_classes(docs), key=repr)
    assert len({c for _, c in got}) == 20


def test_pairs_just_similar_enough_become_candidates(spark):
    """Of 20,000 pairs that agree in each register with probability 0.8 none is lost."""
    rng = np.random.default_rng(3)
    a, b = rng.integers(0, 2**64, (2, 20_000, N.REGISTERS), np.uint64)
    b = np.where(rng.random(a.shape) < N.SIMILAR, a, b)
    assert (N.band_keys(a) == N.band_keys(b)).any(axis=1).all()
    pairs = pa.table({k: pa.array(list(N.sketches(s)), pa.list_(pa.int64())) for k, s in (("a", a), ("b", b))})
    df = spark.createDataFrame(pairs)
    assert df.where(N.alike(df["a"], df["b"]) < N.LIKELY).count() == 0


def test_weights_are_rates():
    h = np.array([11, 22], np.uint64)
    s = N.signatures(h, np.array([0, 0]), np.array([3.0, 1.0]), 1, 4096)
    assert abs((s[0] == 11).mean() - 0.75) < 0.04


def test_deduplicate(frame):
    docs = [*DOCS, (20, "same id a"), (20, "same id a."), (None, "alone here")]
    df = frame(docs, "doc_id long, text string")
    kept = N.deduplicate(df)
    assert kept.columns == df.columns
    rows = kept.select("doc_id", "text").collect()
    want = sorted({c for _, c in brute.near_classes(docs) if c is not None})
    assert sorted(r.doc_id for r in rows if r.doc_id is not None) == want
    assert [r.text for r in rows if r.doc_id is None] == ["alone here"]


def test_empty_table(frame):
    df = frame([], "doc_id long, text string")
    assert N.classes(df).count() == 0 and N.deduplicate(df).count() == 0


def test_all_documents(spark, sf_dir, table):
    got = sorted(tuple(r) for r in QUERIES["op5_near_duplicates"](spark, sf_dir).collect())
    assert got == sorted(brute.near_classes(table("documents", "doc_id", "text")))
