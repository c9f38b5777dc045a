import zlib

import brute
import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from feira.llm import resampling
from feira.llm.queries import QUERIES
from feira.llm.text import slices

LONG = "x" * 1000 + " y " + "é日" * 300 + " " + "q" * 126 + " z " + "w" * 40_000
ODD = [
    (1, None), (2, ""), (3, "A"), (4, "a B"), (5, LONG), (6, " ".join(f"w{i % 7}" for i in range(60))),
    (6, " ".join(f"w{i % 7}" for i in range(60))), (7, "one two three " * 40), (None, "one two three " * 40),
    (8, "Ärger, über alles; " * 30), (9, "\n\t .,;" * 9), (10, "\u0000 nul \u0000" * 20),
]
ITEMS = [(1, "one two three four"), (2, None), (3, ""), (4, "über w1 w2")]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(st.sampled_from("aB1é日 .\n"), max_size=300), max_size=6), st.sampled_from([1, 64, 4096]))
def test_crc_of_all_runs(texts, expanded):
    before, resampling.EXPANDED = resampling.EXPANDED, expanded
    try:
        for low, high, data, offsets in slices(pa.array(texts, pa.string()), 200):
            runs, counts = resampling.features(data, offsets)
            for i in range(low, high):
                w = brute.words(texts[i])
                assert counts[i - low] == len(w)
                for k, (crc, each) in enumerate(runs):
                    own = crc[each[i - low]:each[i - low + 1]].tolist()
                    assert own == [zlib.crc32(" ".join(w[j - k:j + 1]).encode()) for j in range(k, len(w))]
    finally:
        resampling.EXPANDED = before


@pytest.mark.parametrize("n", [1, 127, 128, 129, 255, 256, 257, 5000, 70_000])
def test_crc_of_long_words(n):
    data = np.frombuffer(("k" * n).encode(), np.uint8)
    (crc, _), *_ = resampling.features(data, np.array([0, n]))[0]
    assert crc.tolist() == [zlib.crc32(b"k" * n)]


def collected(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_features", "weight", "score", "rank").collect()), key=repr)


@pytest.mark.parametrize("percent", [0, 5, 50, 100])
@pytest.mark.parametrize("items", [ITEMS, []])
def test_odd_texts(spark, frame, percent, items):
    docs, target = frame(ODD, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = collected(resampling.resample(docs, target, percent=percent))
    assert got == sorted(brute.resampled(ODD, [t for _, t in items], percent), key=repr)


def test_ranges_do_not_change_ranks(spark, monkeypatch):
    rows = [(i, i * 37 % 50, i % 3 > 0) for i in range(400)]
    scored = spark.createDataFrame(rows, "doc_id long, score long, able boolean")
    want = sorted((r for r in rows if r[2]), key=lambda r: (-r[1], r[0]))[:266 * 30 // 100]
    for ranges in (1, 3, 200):
        monkeypatch.setattr(resampling, "RANGES", ranges)
        out = resampling.draw(scored, "doc_id", resampling.F.col("able"), 30).where("rank is not null")
        assert [r["doc_id"] for r in out.orderBy("rank").collect()] == [r[0] for r in want]


def test_columns_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b", 3, "x")], "doc_id long, text string, Score int, _text string")
    target = spark.createDataFrame([], "text string")
    out = resampling.resample(docs, target)
    assert out.columns == ["doc_id", "_text", "n_features", "n_words", "weight", "score", "rank"]
    assert [r["n_features"] for r in out.collect()] == [3]
    assert resampling.resample(docs.limit(0), target).collect() == []


def test_all_documents(spark, sf_dir, table):
    got = collected(QUERIES["op11_importance_resampling"](spark, sf_dir))
    want = brute.resampled(table("documents", "doc_id", "text"), [t for _, t in table("benchmark", "item_id", "text")])
    assert got == sorted(want, key=repr) and any(r[4] for r in got)
