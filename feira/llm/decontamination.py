"""Finds benchmark passages in documents by suffix arrays over the documents.

Each slice of documents that a task reads is a shard. Words that no benchmark item holds
end a match wherever they stand, so the shard is reduced to its runs of benchmark words
that are long enough for a window, and a suffix array is built over those. All suffixes of
all items are then searched for in it at once: an interval of the array holds the places
that agree with the first d words of a suffix, and every further word narrows it by binary
search. The interval after a window's words holds that window's places; the depth at which
a place leaves the last of its intervals is its longest verbatim match.

The benchmark is cut into blocks of bounded size, which are broadcast; each block is one
pass over the documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feira.llm.text import column_bytes, free_name, map_arrow, slices, words
from feira.plans.tables import staged

WINDOW = 13
BLOCK_BYTES = 16 << 20  # benchmark text in one broadcast
WINDOW_MOST = 1 << 20  # more words than a window has
SHARE = 20  # contaminated: at least one word in so many is hit

RUN = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
FOUND = T.StructType([
    T.StructField("n_words", T.LongType()), T.StructField("hits", T.ArrayType(RUN)),
    T.StructField("items", T.ArrayType(T.StringType())),
    T.StructField("longest", T.LongType()), T.StructField("longest_at", T.LongType()),
])


@dataclass
class Block:
    """Benchmark items, as word numbers 1, 2, ... and 0 after each item."""

    vocabulary: np.ndarray  # sorted hashes of the words
    maybe: np.ndarray  # by the low bits of a hash: whether any word has them
    tokens: np.ndarray
    items: list[str]
    item: np.ndarray  # of each token
    left: np.ndarray  # words from each token to the end of its item
    window: np.ndarray  # words of the window that starts at each token; 0: none does
    shortest: int


LOW_BITS = np.uint64((1 << 20) - 1)


def block_of(items: list[str], texts: list[str], n: int) -> Block:
    data, offsets = column_bytes(pa.array(texts, pa.string()))
    w = words(data, offsets)
    vocabulary, numbers = np.unique(w.hashes, return_inverse=True)
    maybe = np.zeros(int(LOW_BITS) + 1, bool)
    maybe[vocabulary & LOW_BITS] = True
    count = np.diff(w.first)
    item = np.repeat(np.arange(len(items)), count + 1)
    at = np.arange(len(item))
    last = np.cumsum(count + 1) - 1
    tokens = np.zeros(len(item), np.int64)
    is_word = np.ones(len(item), bool)
    is_word[last] = False
    tokens[is_word] = numbers + 1
    left = last[item] - at if len(item) else at
    size = np.minimum(count, n)
    window = np.where((left >= size[item]) & (left > 0), size[item], 0) if len(item) else at
    return Block(vocabulary, maybe, tokens, items, item, left, window,
                 int(size[size > 0].min()) if (size > 0).any() else 0)


def blocks(benchmark: DataFrame, key: str, column: str, n: int, most: int) -> Iterator[Block]:
    items, texts, held = [], [], 0
    for item, text in benchmark.select(
        F.coalesce(F.col(f"`{key}`").cast("string"), F.lit("")), F.coalesce(F.col(f"`{column}`"), F.lit(""))
    ).toLocalIterator():
        if texts and held + len(text) > most:
            yield block_of(items, texts, n)
            items, texts, held = [], [], 0
        items.append(item)
        texts.append(text)
        held += len(text)
    yield block_of(items, texts, n)


def suffix_array(tokens: np.ndarray, depth: int) -> np.ndarray:
    """Positions of tokens in the order of what follows them, by at least depth tokens."""
    rank, k = tokens, 1
    while k < depth:
        after = np.zeros_like(rank)
        after[:-k] = rank[k:] + 1
        _, new = np.unique(rank * (int(rank.max()) + 2) + after, return_inverse=True)
        rank, k = new.astype(np.int64), 2 * k
        if int(rank.max()) == len(rank) - 1:
            break
    return np.argsort(rank, kind="stable")


def bisect(values: np.ndarray, wanted: np.ndarray, low: np.ndarray, high: np.ndarray, right: bool) -> np.ndarray:
    """For each i the first place in low[i]..high[i] whose value is not below (right: is
    above) wanted[i]; values is a function of places."""
    low, high = low.copy(), high.copy()
    active = np.flatnonzero(low < high)
    while len(active):
        middle = (low[active] + high[active]) >> 1
        v = values(middle)
        up = v <= wanted[active] if right else v < wanted[active]
        low[active[up]] = middle[up] + 1
        high[active[~up]] = middle[~up]
        active = active[low[active] < high[active]]
    return low


def search(tokens: np.ndarray, order: np.ndarray, block: Block):
    """Occurring windows (first and past-last place in order, words, items' tokens), and for each place
    of tokens the length of the longest match that starts there; 0 for less than the shortest window."""
    at = np.flatnonzero(block.left > 0)
    low, high = np.zeros(len(at), np.int64), np.full(len(at), len(order), np.int64)
    found, matched, depth = [], np.zeros(len(order), np.int64), 0

    def mark(low, high):
        # Intervals of one depth are equal or apart; deeper ones come later and overwrite.
        if depth >= block.shortest and len(low):
            low, one = np.unique(low, return_index=True)
            matched[order[spread(low, high[one] - low)]] = depth

    padded = np.concatenate([tokens, np.zeros(1, np.int64)])
    while len(at):
        def value(place, depth=depth):
            return padded[np.minimum(order[place] + depth, len(tokens))]

        wanted = block.tokens[at + depth]
        first = bisect(value, wanted, low, high, False)
        last = bisect(value, wanted, first, high, True)
        shrunk = last - first < high - low
        mark(low[shrunk], high[shrunk])
        low, high, depth = first, last, depth + 1
        some = low < high
        at, low, high = at[some], low[some], high[some]
        done = block.window[at] == depth
        if done.any():
            found.append((low[done], high[done], np.full(int(done.sum()), depth), at[done]))
        more = block.left[at] > depth
        mark(low[~more], high[~more])
        at, low, high = at[more], low[more], high[more]
    if not found:
        return [np.empty(0, np.int64)] * 4, matched
    return [np.concatenate(x) for x in zip(*found)], matched


def spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """starts[i], starts[i] + 1, ... (sizes[i] numbers), for all i."""
    return np.arange(int(sizes.sum())) + np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)


def scan_slice(data: np.ndarray, offsets: np.ndarray, block: Block) -> list[tuple]:
    """A row of FOUND for each text of a slice."""
    w = words(data, offsets)
    n_words = np.diff(w.first)
    out = [(int(n), [], [], 0, None) for n in n_words]
    if not len(w.hashes) or not block.shortest:
        return out
    # Word numbers, 0 for words of no item.
    number = np.zeros(len(w.hashes), np.int64)
    likely = np.flatnonzero(block.maybe[w.hashes & LOW_BITS])
    if not len(likely):
        return out
    place = np.minimum(np.searchsorted(block.vocabulary, w.hashes[likely]), len(block.vocabulary) - 1)
    number[likely] = np.where(block.vocabulary[place] == w.hashes[likely], place + 1, 0)
    # Runs of such words within a text that are long enough for the shortest window.
    text = np.repeat(np.arange(len(n_words)), n_words)
    inside = np.concatenate([[False], number > 0, [False]])
    new_text = np.concatenate([[True], text[1:] != text[:-1], [True]])
    run_start = np.flatnonzero(inside[1:-1] & (~inside[:-2] | new_text[:-1]))
    run_end = np.flatnonzero(inside[1:-1] & (~inside[2:] | new_text[1:])) + 1
    enough = run_end - run_start >= block.shortest
    run_start, run_end = run_start[enough], run_end[enough]
    if not len(run_start):
        return out
    size = run_end - run_start
    source = spread(run_start, size)
    tokens = np.zeros(len(source) + len(size), np.int64)
    own = np.arange(len(source)) + np.repeat(np.arange(len(size)), size)
    tokens[own] = number[source]
    back = np.full(len(tokens), -1, np.int64)
    back[own] = source
    order = suffix_array(tokens, int(block.left.max()))
    (low, high, length, at), matched = search(tokens, order, block)
    if not len(low):
        return out
    # Equal windows of several items have equal intervals.
    windows, which = np.unique(low * (WINDOW_MOST + 1) + length, return_inverse=True)
    first = np.zeros(len(windows), np.int64)
    first[which] = np.arange(len(low))
    w_low, w_size, w_length = low[first], (high - low)[first], length[first]
    window_item = np.unique(which * len(block.items) + block.item[at])
    item_start = np.searchsorted(window_item, np.arange(len(windows)) * len(block.items))
    item_size = np.diff(np.append(item_start, len(window_item)))
    hit = back[order[spread(w_low, w_size)]]  # word where an occurrence starts
    hit_window = np.repeat(np.arange(len(windows)), w_size)
    cover = np.zeros(len(w.hashes) + 1, np.int64)
    np.add.at(cover, hit, 1)
    np.add.at(cover, hit + w_length[hit_window], -1)
    covered = np.concatenate([[False], np.cumsum(cover[:-1]) > 0, [False]])
    start = np.flatnonzero(covered[1:-1] & (~covered[:-2] | new_text[:-1]))
    end = np.flatnonzero(covered[1:-1] & (~covered[2:] | new_text[1:])) + 1
    pair = np.unique(text[hit] * len(windows) + hit_window)
    pair_text, pair_window = pair // len(windows), pair % len(windows)
    sizes = item_size[pair_window]
    items = window_item[spread(item_start[pair_window], sizes)] % len(block.items)
    text_item = np.unique(np.repeat(pair_text, sizes) * len(block.items) + items)
    # Longest verbatim match of each text, and the first place that has it.
    longest = np.zeros(len(n_words), np.int64)
    np.maximum.at(longest, text[source], matched[own])
    best = source[(matched[own] > 0) & (matched[own] == longest[text[source]])]
    best = best[np.unique(text[best], return_index=True)[1]]
    longest_at = np.zeros(len(n_words), np.int64)
    longest_at[text[best]] = best - w.first[text[best]]
    bounds = np.searchsorted(text_item, np.arange(len(n_words) + 1) * len(block.items))
    h_bounds = np.searchsorted(start, w.first)
    for t in np.unique(pair_text).tolist():
        base = int(w.first[t])
        spans = [{"start": int(a) - base, "end": int(b) - base}
                 for a, b in zip(start[h_bounds[t]:h_bounds[t + 1]], end[h_bounds[t]:h_bounds[t + 1]])]
        ids = sorted({block.items[i] for i in (text_item[bounds[t]:bounds[t + 1]] % len(block.items)).tolist()})
        out[t] = (int(n_words[t]), spans, ids, int(longest[t]), int(longest_at[t]))
    return out


def scan(docs: DataFrame, block: Block, keep: list[str], column: str) -> DataFrame:
    """One pass: the keep columns of each row and FOUND."""
    shared = docs.sparkSession.sparkContext.broadcast(block)
    carried = docs.select(
        *[F.col(f"`{c}`") for c in keep], F.col(f"`{column}`").alias(free_name(keep, "_text"))
    )
    schema = T.StructType([*carried.schema[:-1], *FOUND])
    arrow = pa.schema([
        ("n_words", pa.int64()),
        ("hits", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
        ("items", pa.list_(pa.string())), ("longest", pa.int64()), ("longest_at", pa.int64()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, data, offsets in slices(batch.column(batch.num_columns - 1)):
                rows = scan_slice(data, offsets, shared.value)
                found = [pa.array([r[k] for r in rows], f.type) for k, f in enumerate(arrow)]
                yield pa.RecordBatch.from_arrays(
                    [*[c.slice(low, high - low) for c in batch.columns[:-1]], *found], schema.names
                )

    return map_arrow(carried, run, schema)


def merged(passes: list[DataFrame], keep: list[str]) -> DataFrame:
    """The findings of several passes over the same rows as those of one."""
    every = passes[0]
    for p in passes[1:]:
        every = every.unionByName(p)
    # Equal rows are found equal; they are put apart again by their number.
    grouped = every.groupBy(*[F.col(f"`{c}`") for c in keep], "n_words").agg(
        F.expr(f"count(*) div {len(passes)}").alias("_copies"),
        F.array_sort(F.flatten(F.collect_list("hits"))).alias("hits"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        F.max(F.struct("longest", (-F.col("longest_at")).alias("longest_at"))).alias("_longest"),
    )
    join = """aggregate(hits, cast(array() as array<struct<start: bigint, end: bigint>>), (done, h) ->
        if(size(done) > 0 and element_at(done, -1).end >= h.start,
           concat(slice(done, 1, size(done) - 1), array(named_struct(
               'start', element_at(done, -1).start, 'end', greatest(element_at(done, -1).end, h.end)))),
           concat(done, array(h))))"""
    return grouped.select(
        *[F.col(f"`{c}`") for c in keep], "n_words", F.expr(join).alias("hits"), "items",
        F.col("_longest.longest").alias("longest"), (-F.col("_longest.longest_at")).alias("longest_at"),
        F.explode(F.sequence(F.lit(1), F.col("_copies"))).alias("_copy"),
    ).drop("_copy")


def find_matches(
    docs: DataFrame, benchmark: DataFrame, keep: list[str], column: str = "text",
    item_key: str = "item_id", item_column: str = "text", n: int = WINDOW,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The keep columns of each document with n_words, hits (runs of hit words), items
    (whose windows occur), longest (words of the longest verbatim match among documents
    with hits) and longest_at.

    A null text has no words and no hits; a very long one is searched whole, in a slice of its
    own; repeated documents are searched each. An item without words has no window; repeated
    items count once by their id. An empty benchmark finds nothing, an empty table gives
    an empty result. Other columns are ignored, whatever their names; a kept column that
    is named like a new one gives way.
    """
    keep = [c for c in keep if c.lower() not in FOUND.names]
    passes = [
        scan(docs, block, keep, column)
        for block in blocks(benchmark, item_key, item_column, n, block_bytes)
    ]
    if len(passes) == 1:
        return passes[0]
    return merged([staged(p, "matches") for p in passes], keep)


def n_hit() -> Column:
    return F.aggregate("hits", F.lit(0).cast("long"), lambda n, h: n + h["end"] - h["start"])


def contaminated() -> Column:
    return (n_hit() > 0) & (SHARE * n_hit() >= F.col("n_words"))


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, column: str = "text") -> DataFrame:
    """docs without those of which at least one word in SHARE belongs to benchmark items."""
    own = [f"c{i}" for i in range(len(docs.columns))]  # clear of the names of the findings
    found = find_matches(docs.toDF(*own), benchmark, own, own[docs.columns.index(column)])
    return found.where(~contaminated()).select(*own).toDF(*docs.columns)
