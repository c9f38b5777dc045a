import hashlib

import brute
import pyarrow as pa
import pytest

from feira.llm import decontamination as D
from feira.llm.queries import QUERIES
from feira.llm.text import column_bytes

A = "abc def ghi jkl mno pqr stu vwx yz1 2 3 4 5 6 7 8 9".split()
DOCS = [
    (1, " ".join(A)), (2, None), (3, ""), (4, "x " + " ".join(A[:13]) + " y " + " ".join(A[3:16])),
    (5, "É é ABC ghi"), (6, "Q z Q z Q z Q"), (1, " ".join(A)), (7, " ".join(A * 3)), (8, "abc. def"),
    (None, "z, q!"), (9, ("pad " * 5000) + " ".join(A)), (10, " ".join(A[:12])),
]
ITEMS = [
    (1, " ".join(A)), (2, "z q"), (3, None), (4, "..."), (5, "é"), (6, " ".join(A[2:])), (2, "q"),
    (7, " ".join(A * 2)), (None, "ghi jkl"),
]


def found(docs, items, **options):
    df = D.find_matches(docs, items, ["doc_id"], **options)
    rows = df.withColumn("n_hit", D.n_hit()).withColumn("bad", D.contaminated()).collect()
    return sorted(((r.doc_id, r.n_words, r.n_hit, list(r["items"]), r.bad) for r in rows), key=repr)


@pytest.mark.parametrize("block", [1 << 20, 30, 1])
def test_against_brute_force(frame, spark, block):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    want = sorted(brute.contamination(DOCS, ITEMS), key=repr)
    assert found(frame(DOCS, "doc_id long, text string"), items, block_bytes=block) == want


def test_small_slices(frame, spark, monkeypatch):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    want = sorted(brute.contamination(DOCS, ITEMS), key=repr)
    block = D.block_of([str(i) for i, _ in ITEMS], [t or "" for _, t in ITEMS], D.WINDOW)
    for key, text in DOCS:
        from feira.llm.text import column_bytes
        import pyarrow as pa
        n, hits, ids, longest, at = D.scan_slice(*column_bytes(pa.array([text], pa.string())), block)[0]
        row = next(r for r in want if r[0] == key)
        assert (n, sum(h["end"] - h["start"] for h in hits)) == row[1:3]
        if longest:
            words, item_words = brute.words(text), [brute.words(t) for _, t in ITEMS]
            match = words[at:at + longest]
            assert any(match == w[i:i + longest] for w in item_words for i in range(len(w)))


def longest_match(text, items):
    """(words, first place) of the longest run of words of a text that an item holds."""
    w, best = brute.words(text), (0, None)
    runs = {tuple(v[i:j]) for v in map(brute.words, items) for i in range(len(v)) for j in range(i + 1, len(v) + 1)}
    for i in range(len(w)):
        n = max((j - i for j in range(i + 1, len(w) + 1) if tuple(w[i:j]) in runs), default=0)
        if n > best[0]:
            best = (n, i)
    return best


def test_longest_match_of_each_text_of_a_slice():
    """Copies of a passage, and shorter parts of it, in one slice."""
    texts = [
        " ".join(A), "pad " + " ".join(A), " ".join(A[:15]), " ".join([*A[2:16], "x", *A]), " ".join(A[:14] * 2), "no", None,
        " ".join(A), "x " + " ".join(A[4:18]) + " abc", "q q z",
    ]
    for items in ([" ".join(A)], [" ".join(A), " ".join([*A[:14], "x"]), "z q"], [" ".join(A), "q"], ["q", "abc def"]):
        block = D.block_of([str(i) for i in range(len(items))], items, D.WINDOW)
        rows = D.scan_slice(*column_bytes(pa.array(texts, pa.string())), block)
        for text, (_, hits, _, longest, at) in zip(texts, rows):
            assert (longest, at) == (longest_match(text, items) if hits else (0, None))


def test_removal_keeps_columns_and_clean_rows(frame, spark):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    docs = frame(DOCS, "doc_id long, text string")
    kept = D.remove_contaminated(docs, items)
    assert kept.columns == docs.columns
    clean = [r[0] for r in brute.contamination(DOCS, ITEMS) if not r[4]]
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == sorted(clean, key=repr)


def test_empty_tables(frame, spark):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    docs = frame(DOCS, "doc_id long, text string")
    assert D.find_matches(docs.limit(0), items, ["doc_id"]).count() == 0
    assert all(r[2] == 0 and r[3] == [] for r in found(docs, items.limit(0)))


def test_all_documents(spark, sf_dir, table):
    rows = QUERIES["op2_decontamination"](spark, sf_dir).collect()
    want = [
        (k, n, hit, len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), bad)
        for k, n, hit, ids, bad in brute.contamination(
            table("documents", "doc_id", "text"), table("benchmark", "item_id", "text"))
    ]
    assert sorted(tuple(r) for r in rows) == sorted(want)
