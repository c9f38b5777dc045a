import brute
import pytest

import corpus_pipeline as C
from feira.llm import packing
from feira.plans.tables import staged

import public_tokenizers


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    """What goes into each stage, and what the last returns."""
    docs, out = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for name, stage in C.STAGES:
        out.append(docs)
        docs = staged(stage(spark, docs, sf_dir), "stage")
    return [*out, docs]


def test_columns(stages):
    assert all(s.columns == stages[0].columns for s in stages[:-1])


def test_toxicity(stages):
    before, after = (set(rows_of(s, "doc_id", "text")) for s in stages[:2])
    assert after <= before and len(after) >= 0.7 * len(before)


def test_near_duplicates(stages):
    docs = rows_of(stages[1], "doc_id", "text")
    want = {c for _, c in brute.near_classes(docs)}
    assert sorted(k for (k,) in rows_of(stages[2], "doc_id")) == sorted(want)


def test_decontamination(stages, table):
    found = brute.contamination(rows_of(stages[2], "doc_id", "text"), table("benchmark", "item_id", "text"))
    assert sorted(k for (k,) in rows_of(stages[3], "doc_id")) == sorted(r[0] for r in found if not r[4])


def test_personal_data(stages):
    before, after = dict(rows_of(stages[3], "doc_id", "text")), dict(rows_of(stages[4], "doc_id", "text"))
    assert before.keys() == after.keys()
    for key, text in before.items():
        assert not brute.base_personal_data(after[key])
        if not brute.base_personal_data(text):
            assert after[key] == text
    assert all(len(t) == n for t, n in rows_of(stages[4], "text", "n_chars"))


def test_packing(stages):
    got = rows_of(stages[5], "doc_id", "piece", "start", "length", "ids_crc32")
    want = packing.cut_pieces(stages[4], public_tokenizers.path("word_bpe_49k.json"))
    assert got == rows_of(want, "doc_id", "piece", "start", "length", "ids_crc32")


def test_run(spark, sf_dir, stages):
    assert C.run(spark, sf_dir).count() == stages[5].count()


def test_empty_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0)
    for _, stage in C.STAGES:
        docs = staged(stage(spark, docs, sf_dir), "stage")
    assert docs.count() == 0


def test_odd_documents(spark, sf_dir):
    """Nulls in any column, empty and long texts, repeated rows, and columns of the stages' own
    names go through all stages."""
    prose = " ".join(f"word{i}" for i in range(40))
    rows = [
        (1, None, None, None), (2, "", "en", "s"), (3, prose, "en", None), (3, prose, "en", None), (4, prose + " more", None, "s"),
        (None, "some text of its own with an address a@b.org", "xx", "s"), (None, None, "en", "s"),
        (5, "call +1 (212) 555-0187 now", "en", "s"), (6, "x " * 150_000, "en", "s"), (7, "\n \t", "de", "s"),
    ]
    schema = "doc_id long, text string, lang string, source string, n_chars long, score double, _text string, spans int, node int, label int"
    docs = spark.createDataFrame([(*r, None if r[1] is None else len(r[1]), None, "t", 1, 2, 3) for r in rows], schema)
    kept = docs
    for _, stage in C.STAGES[:-1]:
        kept = staged(stage(spark, kept, sf_dir), "stage")
        assert kept.schema.names == docs.schema.names
    got = {(r["doc_id"], r["text"]) for r in kept.collect()}
    ids = [r["doc_id"] for r in kept.collect()]
    assert ids.count(3) == 1 and 4 not in ids  # a near copy of 3
    assert (5, "call [PHONE] now") in got and (None, "some text of its own with an address [EMAIL]") in got
    assert (6, "x " * 150_000) in got
    packed = C.STAGES[-1][1](spark, kept, sf_dir).collect()
    assert {r["doc_id"] for r in packed} == set(ids) and all(1 <= r["length"] <= 2048 for r in packed)
