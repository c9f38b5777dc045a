"""Importance resampling towards a target distribution of hashed n-grams.

Features are runs of one to three words joined by one space; a feature's bucket is its CRC-32
modulo the number of buckets. A CRC is linear over bits: that of a span is a constant of its
length, XORed with one contribution of each byte, which only depends on the byte and on how far
it is from the end. The contributions lie in a table by distance and byte; those of all spans of
a slice are looked up at once and folded by bitwise_xor.reduceat. A span longer than the table
is cut into blocks, counted from its end; the state of a block moves on by the length of the
next one through four lookups in the same table.

Two passes over the documents: the first sums bucket counts in the tasks and then in Spark, the
second sums the gains of the buckets for each document. The rows that rank highest, with
noise from a hash of the id, are drawn; only rows near the top are shuffled for their rank.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feira.llm.text import IS_WORD, free_name, map_arrow, slices, word_spans
from feira.plans.tables import staged

BUCKETS = 10_000
WORDS = 3  # in the longest feature
DEPTH = 128  # distances in the table
EXPANDED = 1 << 16  # bytes of spans looked up at once
SLICE = 1 << 17  # bytes of texts handled at once, or one longer text
RANGES = 64  # of scores, that are ranked side by side
POLYNOMIAL = 0xEDB88320  # of CRC-32, bits reversed

SPACE = 0x20
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


def _contributions(depth: int) -> np.ndarray:
    """What a byte adds to the state at the end of a span: by distance from the end and byte."""
    state = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        state = (state >> 1) ^ np.where(state & 1, np.uint32(POLYNOMIAL), np.uint32(0))
    out = np.empty((depth, 256), np.uint32)
    out[0] = state
    for d in range(1, depth):  # a zero byte more behind it
        out[d] = (out[d - 1] >> 8) ^ state[out[d - 1] & 0xFF]
    return out


TABLE = _contributions(DEPTH)


def _zeros(lengths: np.ndarray) -> np.ndarray:
    """CRC-32 of as many zero bytes, by ascending lengths."""
    crc, at, out, zeros = 0, 0, np.empty(len(lengths), np.uint32), bytes(1 << 16)
    for i, n in enumerate(lengths.tolist()):
        while at < n:
            some = min(n - at, len(zeros))
            crc, at = zlib.crc32(zeros[:some], crc), at + some
        out[i] = crc
    return out


SHORT = _zeros(np.arange(DEPTH + 1))


def constants(lengths: np.ndarray) -> np.ndarray:
    """The constant of each length, which the contributions of a span's bytes are added to."""
    out = SHORT.take(lengths, mode="clip")
    far = lengths > DEPTH
    if far.any():
        different, where = np.unique(lengths[far], return_inverse=True)
        out[far] = _zeros(different)[where]
    return out


def folded(data: np.ndarray, low: np.ndarray, high: np.ndarray, end: np.ndarray) -> np.ndarray:
    """For each span data[low:high] the XOR of its bytes' contributions at their distances
    from end; low < high <= end <= low + DEPTH. At most EXPANDED bytes are looked up at once."""
    size, out = high - low, np.empty(len(low), np.uint32)
    total, first = np.concatenate([[0], np.cumsum(size)]), 0
    while first < len(low):
        last = max(int(np.searchsorted(total, total[first] + EXPANDED, "right")) - 1, first + 1)
        own, a = size[first:last], low[first:last]
        begin = (total[first:last] - total[first]).astype(np.int32)
        nth = np.arange(int(total[last] - total[first]), dtype=np.int32)
        at = nth + np.repeat((a - begin).astype(np.int32), own)
        distance = np.repeat((end[first:last] - 1 + begin - a).astype(np.int32), own) - nth
        found = TABLE.ravel().take((distance << 8) | data.take(at))
        out[first:last] = np.bitwise_xor.reduceat(found, begin)
        first = last
    return out


def moved(state: np.ndarray) -> np.ndarray:
    """States after DEPTH zero bytes more."""
    out = TABLE[DEPTH - 1][state & 0xFF]
    for k in range(1, 4):
        out = out ^ TABLE[DEPTH - 1 - k][(state >> np.uint32(8 * k)) & 0xFF]
    return out


def long_spans(data: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """The XOR of contributions of spans of any length, folded block by block."""
    blocks = -(-(high - low) // DEPTH)
    order = np.argsort(-blocks, kind="stable")
    low, high, blocks = low[order], high[order], blocks[order]
    first = np.cumsum(blocks) - blocks
    span = np.repeat(np.arange(len(blocks)), blocks)
    end = high[span] - DEPTH * (np.arange(len(span)) - first[span])  # the last block comes first
    each = folded(data, np.maximum(end - DEPTH, low[span]), end, end)
    state = np.zeros(len(low), np.uint32)
    for k in range(int(blocks.max(initial=0)) - 1, -1, -1):
        n = int(np.searchsorted(-blocks, -k, "left"))  # spans with more than k blocks
        state[:n] = moved(state[:n]) ^ each[first[:n] + k]
    out = np.empty_like(state)
    out[order] = state
    return out


def features(
    data: np.ndarray, offsets: np.ndarray,
) -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray]:
    """For runs of 1, 2, ... words the CRC-32 of each in order and where those of each text
    begin (and the last end); and the words of each text of a slice."""
    starts, ends = word_spans(data, offsets)
    first = np.searchsorted(starts, offsets)
    counts = np.diff(first)
    # Lower-cased words with one space behind each.
    size = ends - starts
    high = np.cumsum(size + 1) - 1
    low = high - size
    joined = np.full(len(data) + len(starts), SPACE, np.uint8)
    inside = np.ones(int(high[-1]) + 1 if len(high) else 0, bool)
    inside[high] = False
    joined[:len(inside)][inside] = _LOWER[data[IS_WORD[data]]]
    out, nth = [], np.arange(len(starts)) - np.repeat(first[:-1], counts)
    # Runs that end with the same word have the same distances: each is the one that is a
    # word shorter, and the contributions of one word more.
    state = np.zeros(len(starts), np.uint32)
    for k in range(WORDS):
        there = np.flatnonzero(nth >= k)
        begin, end = low[there - k], high[there]
        until = low[there - k + 1] if k else end
        length = end - begin
        far = length > DEPTH
        if far.any():
            near = ~far
            state[there[near]] ^= folded(joined, begin[near], until[near], end[near])
            state[there[far]] = long_spans(joined, begin[far], end[far])
        else:
            state[there] ^= folded(joined, begin, until, end)
        each = np.concatenate([[0], np.cumsum(np.maximum(counts - k, 0))])
        out.append((state[there] ^ constants(length), each))
    return out, counts


def bucket_counts(texts: DataFrame, column: str = "text", buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all rows each bucket holds. Counted in the tasks, summed by Spark;
    the driver gets one row for each bucket that is not empty."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, _, data, offsets in slices(batch.column(0), SLICE):
                for crc, _ in features(data, offsets)[0]:
                    seen += np.bincount(crc % np.uint32(buckets), minlength=buckets)
        there = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(there, pa.int64()), pa.array(seen[there])], ["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    counted = map_arrow(texts.select(F.col(f"`{column}`").alias("text")), count, "bucket long, n long")
    for r in counted.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r["bucket"]] = r["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """For each bucket how much likelier it is in the target, as log odds in thousandths."""
    size, s, t = len(source), int(source.sum()), int(target.sum())
    return np.array([
        math.floor(1000 * math.log((b + 1.0) * (s + size) / ((a + 1.0) * (t + size))))
        for a, b in zip(source.tolist(), target.tolist())
    ], np.int64)


def weighted(docs: DataFrame, gain: np.ndarray, column: str = "text") -> DataFrame:
    """docs without the text, with n_features, n_words and weight."""
    new = T.StructType.fromDDL("n_features long, n_words long, weight long")
    kept = [c for c in docs.columns if c != column and c.lower() not in new.names]
    carried = docs.select(
        *[F.col(f"`{c}`") for c in kept], F.col(f"`{column}`").alias(free_name(kept, "_text"))
    )
    schema = T.StructType([*carried.schema[:-1], *new])
    shared = docs.sparkSession.sparkContext.broadcast(gain)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = shared.value
        for batch in batches:
            found = []
            for low, high, data, offsets in slices(batch.column(batch.num_columns - 1), SLICE):
                runs, words = features(data, offsets)
                n, weight = np.zeros(high - low, np.int64), np.zeros(high - low, np.int64)
                for crc, each in runs:
                    before = np.concatenate([[0], np.cumsum(gain[crc % np.uint32(len(gain))])])
                    n += np.diff(each)
                    weight += np.diff(before[each])
                found.append((n, words, weight))
            columns = [np.concatenate(c) for c in zip(*found)] or [np.empty(0, np.int64)] * 3
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], *[pa.array(c, pa.int64()) for c in columns]], schema.names
            )

    return map_arrow(carried, weigh, schema)


def noise(key: Column, seed: int) -> Column:
    """Gumbel noise in thousandths from a hash of the key; a null key counts as an empty string."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def range_of(value: Column, borders: list[int]) -> Column:
    """How many of the descending borders lie above value, by halving."""
    def search(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(value >= borders[middle], search(low, middle)).otherwise(search(middle + 1, high))

    return search(0, len(borders))


def draw(scored: DataFrame, key: str, eligible: Column, percent: int) -> DataFrame:
    """scored (with key and score) with rank: 1, 2, ... of the highest `percent` % of the
    eligible rows, ties to the smaller key (null last); null for all others.

    The number of eligible rows times percent is rounded down. Ranges of scores, whose borders
    come from an approximate quantile, are counted, so each range can be ranked by itself; any
    borders give the same ranks. Only ranges above the last rank are shuffled.
    """
    able = scored.where(eligible)
    top = [1 - min(1.0, 2 * percent / 100) * (i + 1) / RANGES for i in range(RANGES)]
    found = able.agg(F.count("*").alias("n"), F.percentile_approx("score", top, 10_000).alias("b")).first()
    drawn = percent * found["n"] // 100
    if not drawn:
        return scored.withColumn("rank", F.lit(None).cast("long"))
    borders = sorted(set(found["b"]), reverse=True)
    part = free_name(scored.columns, "_range")
    ranged = scored.withColumn(part, F.when(eligible, range_of(F.col("score"), borders)).cast("int"))
    sizes = dict(ranged.where(F.col(part).isNotNull()).groupBy(part).count().collect())  # at most RANGES + 1
    before, total = {}, 0
    for k in sorted(sizes):
        if total < drawn:
            before[k] = total
        total += sizes[k]
    ahead = F.element_at(F.create_map(*[F.lit(x) for k, n in before.items() for x in (k, n)]), F.col(part))
    order = Window.partitionBy(part).orderBy(F.desc("score"), F.col(f"`{key}`").asc_nulls_last())
    near = ranged.where(F.col(part) <= max(before)).withColumn("rank", F.row_number().over(order) + ahead)
    near = near.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")).cast("long"))
    rest = ranged.where(F.coalesce(F.col(part) > max(before), F.lit(True)))
    return near.unionByName(rest.withColumn("rank", F.lit(None).cast("long"))).drop(part)


def resample(
    docs: DataFrame, target: DataFrame, key: str = "doc_id", column: str = "text", percent: int = 5,
    least: int = 20, seed: int = 42, buckets: int = BUCKETS,
) -> DataFrame:
    """docs without the text, with n_features, n_words, weight, score and rank; the ranked
    rows are the sample.

    Features are those of whole texts; a null or empty text has none and a weight of 0. Rows of
    fewer than `least` words are never drawn. Repeated rows count, and are drawn, each; which
    of equal rows gets which rank is open. A null key is kept. Extra columns pass through, but
    for those named like the five new ones, which are replaced. An empty target gives every
    bucket the gain of its rarity alone; an empty table gives an empty result.
    """
    gain = gains(bucket_counts(docs, column, buckets), bucket_counts(target, column, buckets))
    kept = [c for c in docs.columns if c == key or c.lower() not in ("score", "rank")]
    found = weighted(docs.select(*[F.col(f"`{c}`") for c in kept]), gain, column)
    scored = staged(
        found.withColumn("score", F.col("weight") + noise(F.col(f"`{key}`"), seed)), "weights"
    )
    return draw(scored, key, F.col("n_words") >= least, percent)
