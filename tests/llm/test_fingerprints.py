import brute
import pytest
from pyspark.sql import functions as F

from feira.llm import fingerprints
from feira.llm.queries import QUERIES

DOCS = [
    (5, "a b c d e f g h"), (1, "x"), (1, "x"), (1, "w y z"), (None, "null key é€😀 text"), (9, None), (7, ""),
    (100, "one two three four five six seven"), (-3, "neg neg"), (50, "long " * 20000),
]


def exact_part(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_chars", "edited_sha256").collect()), key=repr)


@pytest.mark.parametrize("buckets", [1, 2, 50])
def test_edits(frame, buckets):
    out = fingerprints.fingerprint_edits(frame(DOCS, "doc_id long, text string"), buckets=buckets)
    assert exact_part(out) == sorted((r[:3] for r in brute.edits(DOCS)), key=repr)


def test_one_and_no_document(frame):
    df = frame(DOCS[:1], "doc_id long, text string")
    one = fingerprints.fingerprint_edits(df).collect()
    assert len(one) == 1 and one[0].near_next == 1.0
    assert fingerprints.fingerprint_edits(df.limit(0)).count() == 0


def test_equal_texts_and_bounds(spark):
    df = spark.createDataFrame([("a b c d e f",), ("A b, c d e f",), ("",), (None,), ("g h i j k l m",)], "text string")
    prints = [r.p for r in fingerprints.with_fingerprint(df, "text", "p").collect()]
    assert prints[0] == prints[1] and prints[2] == prints[3] == "" and prints[0] != prints[4]
    pair = spark.createDataFrame([(a, b) for a in prints for b in prints], "a string, b string")
    near = [r.n for r in pair.select(fingerprints.likeness(F.col("a"), F.col("b")).alias("n")).collect()]
    assert all(0 <= n <= 1 for n in near) and near[1] == 1.0 and near[4] < 0.2


def test_estimates(spark, sf_dir, table):
    rows = {r.doc_id: r for r in QUERIES["op4_fingerprints"](spark, sf_dir).collect()}
    want = brute.edits(table("documents", "doc_id", "text"))
    assert len(rows) == len(want)
    errors = []
    for key, n, sha, near_edited, near_next in want:
        assert (rows[key].n_chars, rows[key].edited_sha256) == (n, sha)
        errors += [abs(rows[key].near_edited - near_edited), abs(rows[key].near_next - near_next)]
    assert sum(errors) / len(errors) < 0.04 and max(errors) < 0.25
