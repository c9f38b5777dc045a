"""Token counts without a shuffle of pre-tokens: a broadcast table, then worker caches.

The splitting pattern of byte-level tokenizers never joins text over a single blank
between two visible characters, so a text may be cut before each such blank and its
pieces counted apart. Each piece is looked up in two tables by hash, all those of a slice of
texts at once. The first holds the frequent pieces of a bounded sample of texts, is filled on
the driver and broadcast; the second is a worker's own, of fixed size. The tokenizer encodes what is
in neither, each different piece of a slice once. The tables only save work: counts are those
of the library whatever they hold, and no piece is shuffled.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feira.llm.piece_cache import LONGEST, LOOKED_UP, Table, different, hashes
from feira.llm.text import free_name, map_arrow, slices

FREQUENT = 65_536  # pieces in the broadcast table
SHARED_BITS = 18  # of its slots; 5 MB
TABLE_BITS = 18  # of the slots of a worker's table; 5 MB
SAMPLE_ROWS = 1000  # texts in the sample of frequent pieces
SAMPLE_CHARS = 10_000  # of each text there

_loaded: dict[str, object] = {}

# Bytes that may end or begin a blank character of more than one byte.
_END = np.isin(np.arange(256), [0x80, *range(0x80, 0x8B), 0x85, 0x9F, 0xA0, 0xA8, 0xA9, 0xAF])
_BEFORE_END = np.isin(np.arange(256), [0xC2, 0x9A, 0x80, 0x81])
_BEGIN = np.isin(np.arange(256), [0xC2, 0xE1, 0xE2, 0xE3])


def load(path: str):
    """The tokenizer at path, loaded once in each worker, single-threaded."""
    if path not in _loaded:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        _loaded[path] = tokenizer
    return _loaded[path]


def special_strings(path: str) -> list[bytes]:
    """What the tokenizer takes out of a text before it splits it."""
    return [t.content.encode() for t in load(path).get_added_tokens_decoder().values()]


def piece_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where the pieces of the texts data[offsets[i]:offsets[i + 1]] (UTF-8 bytes) start: at
    each text's first byte, and at single blanks between characters that are surely visible."""
    n = len(data)
    cut = np.zeros(n, bool)
    if n > 2:
        before, after = data[:-2], data[2:]
        seen = (before > 0x20) & (after > 0x20) & ~_BEGIN[after]
        doubtful = _END[before]
        doubtful[1:] &= _BEFORE_END[data[:-3]]
        cut[1:-1] = (data[1:-1] == 0x20) & seen & ~doubtful
    inner = offsets[(offsets > 0) & (offsets < n)]
    cut[inner - 1] = False  # a blank that ends its text
    cut[offsets[:-1][offsets[:-1] < offsets[1:]]] = True
    return np.flatnonzero(cut)


def encoded_sizes(tokenizer, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The token numbers of pieces, by the tokenizer."""
    raw, out = data.tobytes(), [np.empty(0, np.int64)]
    for low in range(0, len(starts), 4096):
        some = [raw[a:b].decode() for a, b in zip(starts[low:low + 4096].tolist(), ends[low:low + 4096].tolist())]
        out.append(np.array([len(e) for e in tokenizer.encode_batch_fast(some, add_special_tokens=False)], np.int64))
    return np.concatenate(out)


class Counter:
    """Token numbers of texts, by a shared table and an own one."""

    def __init__(self, path: str, shared: Table | None, bits: int = TABLE_BITS) -> None:
        self.tokenizer, self.special = load(path), special_strings(path)
        self.shared, self.own = shared or Table(0), Table(bits)

    def of(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """The token number of each text data[offsets[i]:offsets[i + 1]] (UTF-8 bytes)."""
        starts = piece_starts(data, offsets)
        raw = data.tobytes()
        if any(s in raw for s in self.special):
            # Texts with special strings are one piece.
            for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
                if any(raw.find(s, a, b) >= 0 for s in self.special):
                    starts = starts[(starts <= a) | (starts >= b)]
        ends = np.append(starts[1:], len(data)) if len(starts) else starts
        size = ends - starts
        n = np.empty(len(starts), np.int64)
        short = np.flatnonzero(size <= LONGEST)
        keys = hashes(data, starts[short], size[short])
        for table in (self.shared, self.own):
            slot = table.find(keys)
            known = slot >= 0
            n[short[known]] = table.sizes[slot[known]]
            short, keys = short[~known], keys[:, ~known]
        one, number = different(keys)
        long = np.flatnonzero(size > LONGEST)
        wanted = np.concatenate([short[one], long])
        new = encoded_sizes(self.tokenizer, data, starts[wanted], ends[wanted])
        n[short], n[long] = new[number], new[len(one):]
        self.own.store(keys[:, one], new[:len(one)])
        total = np.concatenate([[0], np.cumsum(n)])
        return np.diff(total[np.searchsorted(starts, offsets)])


def frequent_pieces(docs: DataFrame, path: str, column: str = "text", most: int = FREQUENT) -> Table:
    """The most frequent pieces of the first texts that Spark reads, with their token numbers.

    At most SAMPLE_ROWS texts, of each at most SAMPLE_CHARS characters, reach the driver, from
    as few partitions as hold that many.
    """
    text = F.col(f"`{column}`")
    rows = docs.select(F.substring(text, 1, SAMPLE_CHARS).alias("text")).where(F.length("text") > 0)
    seen: dict[tuple[int, int], tuple[int, bytes]] = {}
    texts = pa.array([r["text"] for r in rows.limit(SAMPLE_ROWS).collect()], pa.string())
    for _, _, data, offsets in slices(texts, LOOKED_UP):
        starts = piece_starts(data, offsets)
        ends = np.append(starts[1:], len(data))
        fits = ends - starts <= LONGEST
        starts, ends, raw = starts[fits], ends[fits], data.tobytes()
        keys = hashes(data, starts, ends - starts)
        one, number = different(keys)
        for i, n in zip(one.tolist(), np.bincount(number, minlength=len(one)).tolist()):
            key = (int(keys[0, i]), int(keys[1, i]))
            seen[key] = (seen[key][0] + n if key in seen else n, raw[starts[i]:ends[i]])
    top = sorted(seen.items(), key=lambda x: (-x[1][0], x[1][1]))[:most]
    table = Table(SHARED_BITS)
    if top:
        found = load(path).encode_batch_fast([piece.decode("utf-8", "replace") for _, (_, piece) in top], add_special_tokens=False)
        table.store(np.array([k for k, _ in top], np.uint64).T.copy(), np.array([len(e) for e in found]))
    return table


_own_tables: dict[str, Table] = {}


def count_tokens(
    docs: DataFrame, path: str, column: str = "text", limit: int = 512, frequent: int = FREQUENT,
) -> DataFrame:
    """docs with n_bytes (UTF-8), n_tokens and over_limit in place of the text column.

    A null text counts as empty: no bytes, no tokens. Strings of special tokens inside a
    text count as one token, as the library has it. A very long text is a slice of its own.
    Repeated rows are counted each; extra columns pass through, but for those named like the
    three new ones, which are replaced. An empty table gives an empty result.
    """
    table = docs.sparkSession.sparkContext.broadcast(frequent_pieces(docs, path, column, frequent))
    new = T.StructType.fromDDL("n_bytes long, n_tokens long, over_limit boolean")
    kept = [c for c in docs.columns if c != column and c.lower() not in new.names]
    carried = docs.select(
        *[F.col(f"`{c}`") for c in kept], F.col(f"`{column}`").alias(free_name(kept, "_text"))
    )
    schema = T.StructType([*carried.schema[:-1], *new])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(path, table.value)
        counter.own = _own_tables.setdefault(path, counter.own)
        for batch in batches:
            texts = batch.column(batch.num_columns - 1).fill_null("")
            n = [counter.of(data, offsets) for _, _, data, offsets in slices(texts, LOOKED_UP)]
            n = pa.array(np.concatenate([np.empty(0, np.int64), *n]))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pc.binary_length(texts).cast(pa.int64()), n, pc.greater(n, limit)],
                schema.names,
            )

    return map_arrow(carried, count, schema)
