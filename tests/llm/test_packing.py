import tracemalloc
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from feira.llm import packing
from feira.llm.queries import QUERIES
from feira.llm.text import slices

PATH = public_tokenizers.path("word_bpe_49k.json")


def expected(docs, most=packing.SEQUENCE):
    tokenizer, out = Tokenizer.from_file(PATH), []
    for key, text in docs:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        for k, at in enumerate(range(0, len(ids), most)):
            part = ids[at:at + most]
            out.append((key, k, at, len(part), zlib.crc32(part.tobytes())))
    return out


def check(rows, docs, most=packing.SEQUENCE):
    """Pieces are right, bins gapless and not over-full; the number of bins."""
    assert sorted((tuple(r)[:5] for r in rows), key=repr) == sorted(expected(docs, most), key=repr)
    bins = defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    for places in bins.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= most
    return len(bins)


ODD = [
    (1, None), (2, ""), (3, "Don't stop! it's 3 o'clock now"), (4, "a\x1cb \x1d c"), (5, "<|endoftext|> x<|endoftext|>"),
    (6, "é é ÀÖ İstanbul ΑΣ ß ﬁ Kelvin K"), (7, "word " * 9000), (7, "word " * 9000), (None, "日本語 テスト 😀"),
    (8, "Anea, anea. ANEA; anea's x.y 12ab"), (9, "  　 \t\n"), (10, "z" * 5000),
]


def test_odd_texts(frame):
    rows = packing.pack(frame(ODD, "doc_id long, text string"), PATH).collect()
    check(rows, ODD)


@pytest.mark.parametrize("most", [1, 7, 64])
def test_short_sequences(frame, most):
    check(packing.pack(frame(ODD[:9], "doc_id long, text string"), PATH, most=most).collect(), ODD[:9], most)


@pytest.mark.parametrize("bits", [1, 4, packing.TABLE_BITS])
def test_small_tables(bits):
    """Parts that push each other out of their slots, or are never stored, keep their ids."""
    words, texts = packing.WordIds(PATH, bits), [t or "" for _, t in ODD] * 2
    tokenizer = Tokenizer.from_file(PATH)
    want = [[*tokenizer.encode(t, add_special_tokens=False).ids, 0] for t in texts]
    for most in (1, 200, 1 << 20):
        got = []
        for _, _, data, offsets in slices(pa.array(texts, pa.string()), most):
            ids, first = words.of(data, offsets)
            got += [ids[a:b].tolist() for a, b in zip(first[:-1], first[1:])]
        assert got == want


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.sampled_from("aB1'é \n\t.\x0b\x1c\xa0ΣİK<|>"), max_size=20), max_size=5))
def test_ids_of_any_text(texts):
    words, tokenizer = packing.word_ids(PATH), packing.load(PATH)
    for _, _, data, offsets in slices(pa.array(texts, pa.string()), 30):
        ids, first = words.of(data, offsets)
        for k, (a, b) in enumerate(zip(offsets[:-1], offsets[1:])):
            text = data[a:b].tobytes().decode()
            assert ids[first[k]:first[k + 1]].tolist() == [*tokenizer.encode(text, add_special_tokens=False).ids, 0]


def test_memory_of_long_texts():
    """A worker's table and one batch of 256 texts of 200 KB stay within 64 MB."""
    rng = np.random.default_rng(1)
    vocabulary = ["".join(rng.choice(list("aeioubdnst"), 7)) for _ in range(50_000)]
    texts = pa.array([" ".join(rng.choice(vocabulary, 25_000)) for _ in range(256)], pa.string())
    words = packing.word_ids(PATH)
    tracemalloc.start()
    for _, _, data, offsets in slices(texts, packing.LOOKED_UP):
        words.of(data, offsets)
    assert tracemalloc.get_traced_memory()[1] + words.table.nbytes() < 64 << 20
    tracemalloc.stop()


def test_empty_table(frame):
    assert packing.pack(frame([], "doc_id long, text string"), PATH).count() == 0


def test_all_documents(spark, sf_dir, table):
    rows = QUERIES["op1_best_fit_packing"](spark, sf_dir).collect()
    bins = check(rows, table("documents", "doc_id", "text"))
    assert bins <= 1 + -(-sum(r.length for r in rows) // packing.SEQUENCE)


@pytest.mark.parametrize("seed", range(5))
def test_fullest_is_optimal(seed):
    rng = np.random.default_rng(seed)
    room = 30
    counts = np.zeros(room + 1, np.int64)
    for length in rng.integers(1, room + 1, 8):
        counts[length] += rng.integers(1, 4)
    reach = {0}
    for length in range(1, room + 1):
        for _ in range(counts[length]):
            reach |= {r + length for r in reach if r + length <= room}
    chosen = packing.fullest(counts, room)
    assert sum(chosen) == max(reach)
    assert all(chosen.count(length) <= counts[length] for length in chosen)


def test_kinds_use_every_piece_once():
    counts = np.array([0, 5, 0, 7, 1000, 3, 0, 0, 2, 9, 1])
    used = np.zeros_like(counts)
    kinds = packing.bin_kinds(counts, 10)
    for bins, content in kinds:
        assert sum(length * k for length, k in content.items()) <= 10
        for length, k in content.items():
            used[length] += bins * k
    assert (used == counts).all()
    assert len(kinds) <= 10
