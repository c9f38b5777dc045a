import tracemalloc

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from feira.llm import tokens
from feira.llm.queries import QUERIES
from feira.llm.text import slices

PATH = public_tokenizers.path("byte_bpe_50k.json")


def expected(docs, limit=512):
    tokenizer, out = Tokenizer.from_file(PATH), []
    for key, text in docs:
        n = len(tokenizer.encode(text or "", add_special_tokens=False).ids)
        out.append((key, len((text or "").encode()), n, n > limit))
    return sorted(out, key=repr)


ODD = [
    (1, None), (2, ""), (3, " "), (4, "a  b   c \n\n d\t\te \n f  "), (5, "x<|endoftext|>  y <|endoftext|>"),
    (6, "it's we'll I'd 12 345 é ü   z\x1c q"), (7, "word " * 3000), (7, "word " * 3000), (None, "日本語 😀😀"),
    (8, "\n" * 2000), (9, "q" * 4000),
]


def count(df, **options):
    kept = tokens.count_tokens(df, PATH, **options)
    return sorted((tuple(r) for r in kept.select("doc_id", "n_bytes", "n_tokens", "over_limit").collect()), key=repr)


@pytest.mark.parametrize("frequent", [tokens.FREQUENT, 1])
def test_odd_texts(frame, frequent):
    assert count(frame(ODD, "doc_id long, text string"), frequent=frequent) == expected(ODD)


def test_clashing_names_and_empty_table(spark):
    df = spark.createDataFrame([(1, "a b", 9, "x")], "doc_id long, text string, N_Tokens int, _text string")
    out = tokens.count_tokens(df, PATH, limit=1)
    assert [tuple(r) for r in out.collect()] == [(1, "x", 3, 2, True)]
    assert tokens.count_tokens(df.limit(0), PATH).count() == 0


def test_all_documents(spark, sf_dir, table):
    rows = sorted((tuple(r) for r in QUERIES["op7_token_counts"](spark, sf_dir).collect()), key=repr)
    assert rows == expected(table("documents", "doc_id", "text"))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.sampled_from(" \n\ta1é's.\x1c\x85\xa0\u2003\u3000日“"), max_size=14), max_size=4))
def test_pieces_add_up(texts):
    encode = lambda t: tokens.load(PATH).encode(t, add_special_tokens=False).ids
    for _, _, data, offsets in slices(pa.array(texts, pa.string()), 40):
        starts = tokens.piece_starts(data, offsets)
        ends = [*starts[1:], len(data)]
        for a, b in zip(offsets[:-1], offsets[1:]):
            own = [data[s:e].tobytes().decode() for s, e in zip(starts, ends) if a <= s < b]
            text = data[a:b].tobytes().decode()
            assert "".join(own) == text
            assert sum((encode(p) for p in own), []) == encode(text)


@pytest.mark.parametrize("bits", [1, 3, tokens.TABLE_BITS])
def test_small_tables(bits):
    """Pieces that push each other out of their slots keep their numbers."""
    texts = [t or "" for _, t in ODD] * 2
    want = [len(tokens.load(PATH).encode(t, add_special_tokens=False).ids) for t in texts]
    for most in (1, 300, 1 << 20):
        counter = tokens.Counter(PATH, None, bits)
        got = [n for _, _, d, o in slices(pa.array(texts, pa.string()), most) for n in counter.of(d, o).tolist()]
        assert got == want


def test_no_shuffle(spark, frame):
    df = tokens.count_tokens(frame(ODD, "doc_id long, text string"), PATH)
    assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()


def test_memory_of_long_texts():
    """A worker's tables and one batch of 256 texts of 200 KB stay within 48 MB."""
    rng = np.random.default_rng(1)
    vocabulary = ["".join(rng.choice(list("aeioubdnst"), 7)) for _ in range(50_000)]
    texts = pa.array([" ".join(rng.choice(vocabulary, 25_000)) for _ in range(256)], pa.string())
    counter = tokens.Counter(PATH, tokens.Table(tokens.SHARED_BITS))
    tracemalloc.start()
    for _, _, data, offsets in slices(texts, tokens.LOOKED_UP):
        counter.of(data, offsets)
    assert tracemalloc.get_traced_memory()[1] + counter.own.keys.nbytes + counter.shared.keys.nbytes < 48 << 20
    tracemalloc.stop()
