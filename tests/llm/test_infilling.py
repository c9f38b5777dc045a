import hashlib

import brute
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from feira.llm import infilling

LONG = "It's a long text, über 1,000 ünits. " * 3000
ODD = [
    (1, None), (2, ""), (3, " "), (4, "a"), (5, "<P> marks <S> of <M> the output"), (6, "cut <M off <P< S>"),
    *[(k, "Words and 日本語 😀 marks, é\r\n" * (k % 5)) for k in range(7, 60)], (60, LONG), (60, LONG),
    (61, "twice"), (61, "twice"), (61, "once"), (None, "no key"), (None, None), (62, "<" * 50 + "P>" * 9),
]


def expected(rows):
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    out = []
    for key, text in rows:
        *head, output = brute.infilled(key, text)
        out.append((*head, sha(output), sha(text or "")))
    return sorted(out, key=repr)


@pytest.mark.parametrize("chunk", [1, 7, infilling.CHUNK])
def test_odd_texts(frame, chunk):
    rows = ODD if chunk > 1 else [r for r in ODD if len(r[1] or "") < 10_000]
    got = infilling.digests(frame(rows, "doc_id long, text string"), chunk=chunk)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == expected(rows)


def test_outputs(frame):
    want = sorted(((k, form, o) for k, _, form, _, _, o in (brute.infilled(*r) for r in ODD) if o), key=repr)
    rows = infilling.outputs(frame(ODD, "doc_id long, text string"), chunk=4).collect()
    whole = {}
    for r in sorted(rows, key=lambda r: r["number"]):
        whole.setdefault((r["doc_id"], r["form"], r["number"]), []).append(r["output"])
    singles = {(k, f) for k, f, _ in want if sum(w[0] == k for w in want) == 1}
    for key, form in singles:
        parts = [v[0] for (k, f, _), v in whole.items() if (k, f) == (key, form)]
        assert (key, form, "".join(parts)) in want
    assert sum(len(o) for _, _, o in want) == sum(len(r["output"]) for r in rows)


def test_all_forms_and_empty_table(spark, frame):
    forms = {brute.infilled(k, t)[2] for k, t in ODD}
    assert forms == {"plain", "psm", "spm"}
    assert infilling.digests(frame([], "doc_id long, text string")).collect() == []


@settings(max_examples=200, deadline=None)
@given(st.integers(0, 10**6), st.text(st.sampled_from("ab <PSM>é日\n"), max_size=40), st.integers(1, 9))
def test_restoration_from_the_output_alone(key, text, chunk):
    head, chunks = infilling.parts_of(key, text, chunk)
    chunks = list(chunks)
    assert tuple(head) + (b"".join(chunks).decode(),) == brute.infilled(key, text)
    back = sorted(infilling.split_output(head.form, chunks), key=lambda p: p[0])
    assert b"".join(d for _, d in back).decode() == text


def test_copies_are_followed_once():
    records = [((0, b"a", 0, k), k) for k in (0, 0, 0, 1, 1, 1)] + [((0, b"b", 0, 0), 0)]
    got = [(d, list(own)) for d, own in infilling.documents_of(records)]
    assert got == [((0, b"a"), [((0, 0), 0, 3), ((0, 1), 1, 3)]), ((0, b"b"), [((0, 0), 0, 1)])]
    assert [d for d, _ in infilling.documents_of(records)] == [(0, b"a"), (0, b"b")]
