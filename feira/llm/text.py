"""Whole-array text handling inside tasks: Arrow batches, words and their hashes.

Words are the runs that `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` finds once A-Z are lower-cased.
In UTF-8 that is a property of single bytes (ASCII letters, digits, and every byte from
0x80), so words are found and hashed with whole-array operations over the bytes.
"""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

import feira

SLICE_BYTES = 1 << 19  # bytes handled at once; a longer text is a slice of its own
KEPT_POWERS = 1 << 20  # of the base, that a worker keeps; a longer slice makes its own

IS_WORD = np.zeros(256, bool)
for _low, _high in ((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF)):
    IS_WORD[_low:_high + 1] = True
_LOWER = np.arange(256)
_LOWER[0x41:0x5B] += 0x20
# A random odd base and a random value for each byte (lower-cased): the hash of a word is
# a polynomial in the base modulo 2**64, which prefix sums give for all words at once.
_VALUE = np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=np.uint64)[_LOWER]
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 2**64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_tables: tuple[np.ndarray, np.ndarray] | None = None


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _tables
    if _tables is not None and len(_tables[0]) >= n:
        return _tables
    size = max(n, SLICE_BYTES + 1)
    tables = _powers(_BASE, size), _powers(_INVERSE, size)
    if size <= KEPT_POWERS:
        _tables = tables
    return tables


def mix(x: np.ndarray) -> np.ndarray:
    """The finalizer of splitmix64: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass
class Words:
    """The words of a slice of texts, in order."""

    hashes: np.ndarray  # uint64 for each word
    first: np.ndarray  # for each text and one past the last: index of its first word
    starts: np.ndarray  # byte where each word starts
    ends: np.ndarray
    _sums: np.ndarray
    _inverse: np.ndarray

    def prefixes(self, n: int) -> np.ndarray:
        """The hash of each word's first n bytes (of the whole word if it is shorter)."""
        return self._hash(np.minimum(self.starts + n, self.ends))

    def _hash(self, ends: np.ndarray) -> np.ndarray:
        return mix((self._sums[ends] - self._sums[self.starts]) * self._inverse[self.starts])


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the words of the texts data[offsets[i]:offsets[i + 1]] start and end."""
    n = len(data)
    inside = np.zeros(n + 2, bool)
    inside[1:-1] = IS_WORD[data]
    start = inside[1:] & ~inside[:-1]
    end = inside[:-1] & ~inside[1:]
    cuts = offsets[(offsets > 0) & (offsets < n)]
    cuts = cuts[inside[cuts] & inside[cuts + 1]]  # two texts that meet inside a run
    start[cuts] = True
    end[cuts] = True
    return np.flatnonzero(start), np.flatnonzero(end)


def words(data: np.ndarray, offsets: np.ndarray) -> Words:
    """Words of the texts data[offsets[i]:offsets[i + 1]] (UTF-8 bytes)."""
    n = len(data)
    power, inverse = _power_tables(n + 1)
    starts, ends = word_spans(data, offsets)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_VALUE[data] * power[:n], out=sums[1:])
    out = Words(np.empty(0), np.searchsorted(starts, offsets), starts, ends, sums, inverse)
    out.hashes = out._hash(ends)
    return out


def shingles(w: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of n consecutive words, and the text of each.

    A text of fewer words, but not none, is one shingle.
    """
    count = np.diff(w.first)
    full = np.maximum(count - n + 1, 0)
    text = np.repeat(np.arange(len(count)), full)
    at = w.first[text] + np.arange(len(text)) - np.repeat(np.cumsum(full) - full, full)
    h = np.zeros(len(text), np.uint64)
    for k in range(n):
        h = mix(h * np.uint64(_BASE) + w.hashes[at + k])
    short = np.flatnonzero((count > 0) & (count < n))
    if len(short):
        hs = np.zeros(len(short), np.uint64)
        for k in range(n - 1):
            more = count[short] > k
            hs[more] = mix(hs[more] * np.uint64(_BASE) + w.hashes[w.first[short[more]] + k])
        h, text = np.concatenate([h, hs]), np.concatenate([text, short])
        order = np.argsort(text, kind="stable")
        h, text = h[order], text[order]
    return h, text


def column_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and where each text starts. A null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.fill_null("") if texts.null_count else texts
    texts = texts.cast(pa.large_string())
    _, where, data = texts.buffers()
    offsets = np.frombuffer(where, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    low, high = (int(offsets[0]), int(offsets[-1])) if len(offsets) else (0, 0)
    return raw[low:high], offsets - low


def slices(texts: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row past the last, bytes, offsets) of runs of rows of at most `most`
    bytes, or of one longer row."""
    data, offsets = column_bytes(texts)
    low, n = 0, len(offsets) - 1
    while low < n:
        high = int(np.searchsorted(offsets, offsets[low] + most, "right")) - 1
        high = min(max(high, low + 1), n)
        yield low, high, data[offsets[low]:offsets[high]], offsets[low:high + 1] - offsets[low]
        low = high


def small_batches(batch: pa.RecordBatch, at: int, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """batch in runs of rows whose texts in column `at` have at most `most` bytes, or of one
    longer row."""
    for low, high, _, _ in slices(batch.column(at), most):
        yield batch.slice(low, high - low)


def free_name(columns: list[str], name: str) -> str:
    """name, or a longer one that no column has."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = "_" + name
    return name


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Have Spark send this package to the Python workers, once for each application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(feira.__file__).parent
    archive = Path(tempfile.mkdtemp(prefix="run-")) / "feira_package.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for source in sorted(package.rglob("*.py")):
            z.write(source, source.relative_to(package.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)


def map_arrow(
    df: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
    schema: T.StructType | str,
) -> DataFrame:
    """df.mapInArrow with this package at hand in the workers."""
    ship(df.sparkSession)
    return df.mapInArrow(function, schema)
