import brute
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from feira.llm.text import SLICE_BYTES, column_bytes, shingles, slices, words

TEXTS = st.lists(st.text(alphabet="aBz09 .-é€😀\x00\x7f@[`{", max_size=12) | st.none(), max_size=8)


@settings(max_examples=300, deadline=None)
@given(TEXTS)
def test_words(texts):
    data, offsets = column_bytes(pa.array(texts, pa.string()))
    w = words(data, offsets)
    for i, text in enumerate(texts):
        own = range(w.first[i], w.first[i + 1])
        found = [bytes(data[w.starts[j]:w.ends[j]]).decode().translate(brute.LOWER) for j in own]
        assert found == brute.words(text)
    by_word = {}
    for j, h in enumerate(w.hashes.tolist()):
        word = bytes(data[w.starts[j]:w.ends[j]]).decode().translate(brute.LOWER)
        assert by_word.setdefault(word, h) == h
    assert len(set(by_word.values())) == len(by_word)


@settings(max_examples=200, deadline=None)
@given(TEXTS, st.integers(1, 6))
def test_shingles(texts, n):
    data, offsets = column_bytes(pa.array(texts, pa.string()))
    h, text = shingles(words(data, offsets), n)
    for i, t in enumerate(texts):
        w = brute.words(t)
        want = [tuple(w[k:k + n]) for k in range(max(1, len(w) - n + 1))] if w else []
        own = h[text == i].tolist()
        assert len(own) == len(want) and len(set(own)) == len(set(want))


def test_slices_cover_all_rows():
    column = pa.array(["a" * 10, None, "b" * 3 * SLICE_BYTES, "", "c"] * 3).slice(1, 12)
    seen = []
    for low, high, data, offsets in slices(column):
        seen += range(low, high)
        assert [bytes(data[a:b]).decode() for a, b in zip(offsets, offsets[1:])] == [
            t or "" for t in column.slice(low, high - low).to_pylist()]
    assert seen == list(range(12))
