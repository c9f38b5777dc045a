"""Packs documents into sequences of a fixed length by minimum bin slack.

Only the lengths of pieces matter to a packing, and there are no more of those than a
sequence is long. So the tasks tokenize and cut the documents and count pieces by length;
the search for full bins works on that histogram alone, whose size does not depend on the
data; and the tasks turn its answer, so many bins of such and such lengths, back into
places for single pieces.

The search: a bin is begun with the longest length left. A bitset of reachable sums is
extended by one available length after another until the bin is full or all lengths are
used; the fullest sum is traced back to a combination. As the combination stays the
fullest while its lengths last, all bins of that kind are removed at once, which uses up
at least one length: there are at most as many kinds of bins as lengths.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import normalizers, pre_tokenizers

from feira.llm.piece_cache import LONGEST, LOOKED_UP, Table, different, hashes, ranges
from feira.llm.text import map_arrow, slices
from feira.llm.tokens import load
from feira.plans.tables import staged

SEQUENCE = 2048
TABLE_BITS = 18  # of the number of parts in a worker's table
KEPT_IDS = 10  # of a part that is kept there; with the former, 16 MB
TOGETHER = 64  # words that are encoded in one text
WORD_END = "</w>"  # what the vocabulary writes at the last piece of a word
MARKS = ".,;:!?"
MARK_NUMBER = np.array([MARKS.find(chr(b)) + 1 for b in range(256)])
ASCII_UPPER = (np.arange(256) >= 0x41) & (np.arange(256) <= 0x5A)
ASCII_LETTER = ASCII_UPPER | ((np.arange(256) >= 0x61) & (np.arange(256) <= 0x7A))
BLANK = np.isin(np.arange(256), list(b" \t\n\r"))

PIECE = T.StructType([
    T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()),
    T.StructField("length", T.LongType()), T.StructField("ids_crc32", T.LongType()),
])


class WordIds:
    """Ids of texts, by their blank-separated parts.

    The tokenizer's pattern matches no blank and its normalizer joins nothing over one, so the
    ids of a text are those of its parts, and those of a plain word with a mark behind it are
    the word's and the mark's. Parts are looked up in a table of fixed size, all those of a
    slice of texts at once, plain words in lower case. Unknown plain words go to the tokenizer
    many in one text, as the last id of each says so; other parts are encoded one by one.
    """

    def __init__(self, path: str, bits: int = TABLE_BITS) -> None:
        self.tokenizer, self.table = load(path), Table(bits, KEPT_IDS)
        vocabulary = self.tokenizer.get_vocab()
        self.last = np.zeros(max(vocabulary.values()) + 1, bool)
        self.last[[i for t, i in vocabulary.items() if t.endswith(WORD_END)]] = True
        if not self.last.any() or len(self._encode([" \t\n\r "])[0]):
            raise ValueError(f"the vocabulary of {path} does not mark the ends of words, or blanks have ids")
        self.marks = self._encode(["", *MARKS])
        # Plain words need neither the normalizer nor the splitting pattern.
        self.full = self.tokenizer.normalizer, self.tokenizer.pre_tokenizer
        self.bare = normalizers.Sequence([]), pre_tokenizers.Sequence([
            pre_tokenizers.WhitespaceSplit(),
            pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False),
        ])

    def _encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after the other, and how many each has."""
        each = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        return np.array(list(chain.from_iterable(each)), np.uint32), np.array(list(map(len, each)), np.int64)

    def _encode_words(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """As _encode, for texts of which each is one plain word in lower case."""
        all_ids, sizes = [np.empty(0, np.uint32)], [np.empty(0, np.int64)]
        self.tokenizer.normalizer, self.tokenizer.pre_tokenizer = self.bare
        try:
            for low in range(0, len(texts), TOGETHER):
                some = texts[low:low + TOGETHER]
                ids, _ = self._encode([" ".join(some)])
                ends = np.flatnonzero(self.last[ids]) + 1
                own = (ids, np.diff(ends, prepend=0)) if len(ends) == len(some) else self._encode(some)
                all_ids.append(own[0])
                sizes.append(own[1])
        finally:
            self.tokenizer.normalizer, self.tokenizer.pre_tokenizer = self.full
        return np.concatenate(all_ids), np.concatenate(sizes)

    def of(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, first): the ids of the texts data[offsets[i]:offsets[i + 1]] (UTF-8 bytes), each
        with id 0 behind its last, and where those of each text start and the last ends."""
        starts, ends = parts_of(data, offsets)
        folded, plain, mark = plain_words(data, starts, ends)
        size = ends - starts - (mark > 0)
        # Of equal unknown parts one is encoded; long ones each.
        fits = size <= LONGEST
        short, long = np.flatnonzero(fits), np.flatnonzero(~fits)
        keys = hashes(folded, starts[short], size[short])
        slot = np.full(len(starts), -1)
        slot[short] = found = self.table.find(keys)
        missed = np.flatnonzero(found < 0)
        one, number = different(keys[:, missed])
        wanted = np.concatenate([short[missed[one]], long])
        which = np.empty(len(starts), np.int64)  # of the wanted
        which[short[missed]], which[long] = number, len(one) + np.arange(len(long))
        raw, low, high = folded.tobytes(), starts[wanted], starts[wanted] + size[wanted]
        parts = [raw[a:b].decode() for a, b in zip(low.tolist(), high.tolist())]
        is_word = plain[wanted]
        words, odd = np.flatnonzero(is_word), np.flatnonzero(~is_word)
        found_words = self._encode_words([parts[i] for i in words])
        found_odd = self._encode([parts[i] for i in odd])
        new = np.empty(len(parts), np.int64)
        new[words], new[odd] = found_words[1], found_odd[1]
        ids, first = np.empty(int(new.sum()), np.uint32), np.cumsum(new) - new
        copy(ids, first[words], *found_words, np.arange(len(words)))
        copy(ids, first[odd], *found_odd, np.arange(len(odd)))
        # Each part's ids in their place, then its mark's; one place is left behind each text.
        known = slot >= 0
        n = np.where(known, self.table.sizes[slot], 0).astype(np.int64)
        n[~known] = new[which[~known]]
        whole = n + self.marks[1][mark]
        before = np.searchsorted(starts, offsets)
        first = np.concatenate([[0], np.cumsum(whole)])[before] + np.arange(len(offsets))
        to = np.cumsum(whole) - whole + np.repeat(np.arange(len(offsets) - 1), np.diff(before))
        out = np.zeros(int(first[-1]), np.uint32)
        _, at = ranges(to[known], n[known])
        _, source = ranges(slot[known] * KEPT_IDS, n[known])
        out[at] = self.table.values.ravel()[source]
        copy(out, to[~known], ids, new, which[~known])
        marked = np.flatnonzero(mark)
        copy(out, to[marked] + n[marked], *self.marks, mark[marked])
        kept = np.flatnonzero(new[:len(one)] <= KEPT_IDS)
        values = np.zeros((len(kept), KEPT_IDS), np.uint32)
        copy(values.ravel(), np.arange(len(kept)) * KEPT_IDS, ids, new, kept)
        self.table.store(keys[:, missed[one[kept]]], new[kept], values)
        return out, first


def parts_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the runs without blanks of the texts start and end."""
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = ~BLANK[data]
    start, end = inside[1:] & ~inside[:-1], inside[:-1] & ~inside[1:]
    cuts = offsets[(offsets > 0) & (offsets < len(data))]
    cuts = cuts[inside[cuts] & inside[cuts + 1]]  # two texts that meet inside a run
    start[cuts] = end[cuts] = True
    return np.flatnonzero(start), np.flatnonzero(end)


def plain_words(
    data: np.ndarray, starts: np.ndarray, ends: np.ndarray,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(data with the letters of plain parts in lower case, whether each part is plain, the
    number of the mark behind it or 0). A part is plain if it has no characters but letters
    whose lower case is one letter and that no normalization joins to another: A-Z, a-z and
    U+00C0 to U+00FF, in UTF-8 a byte 0xC3 and another, but for U+00D7 and U+00F7. One mark may
    follow them."""
    second = np.zeros(len(data), bool)
    second[1:] = data[:-1] == 0xC3
    letter = ASCII_LETTER[data] | (data == 0xC3) | (second & (data != 0x97) & (data != 0xB7))
    others = np.concatenate([[0], np.cumsum(~letter)])
    mark = MARK_NUMBER[data[ends - 1]]
    core = ends - (mark > 0)
    plain = (core > starts) & (others[core] == others[starts])
    upper = ASCII_UPPER[data] | (second & (data < 0x9F) & (data != 0x97))
    depth = np.zeros(len(data) + 1, np.int8)
    depth[starts[plain]] += 1
    depth[ends[plain]] -= 1
    folded = data + ((upper & np.cumsum(depth[:-1], dtype=np.int8).astype(bool)).astype(np.uint8) << 5)
    return folded, plain, np.where(plain, mark, 0)


def copy(out: np.ndarray, to: np.ndarray, ids: np.ndarray, sizes: np.ndarray, which: np.ndarray) -> None:
    """Copy the chosen ones of runs of ids to their places in out."""
    first = np.cumsum(sizes) - sizes
    _, at = ranges(to, sizes[which])
    _, source = ranges(first[which], sizes[which])
    out[at] = ids[source]


_word_ids: dict[str, WordIds] = {}


def word_ids(path: str) -> WordIds:
    """The one WordIds of a worker."""
    if path not in _word_ids:
        _word_ids[path] = WordIds(path)
    return _word_ids[path]


def cut_pieces(
    docs: DataFrame, path: str, key: str = "doc_id", column: str = "text", most: int = SEQUENCE,
) -> DataFrame:
    """One row per piece: key, piece, start, length, ids_crc32. Only documents of more
    than `most` ids, the closing 0 included, have several."""
    keyed = docs.select(F.col(f"`{key}`").alias(key), F.col(f"`{column}`").alias("_text"))
    schema = T.StructType([keyed.schema[key], *PIECE])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = word_ids(path)
        for batch in batches:
            for low, high, data, offsets in slices(batch.column(1), LOOKED_UP):
                own, first = ids.of(data, offsets)
                own = own.astype("<u4", copy=False)
                size = np.diff(first)
                rows = np.repeat(np.arange(high - low), -(-size // most))
                _, piece = ranges(np.zeros(high - low, np.int64), -(-size // most))
                start = piece * most
                length = np.minimum(size[rows] - start, most)
                at = first[rows] + start
                crc = [zlib.crc32(own[a:a + n]) for a, n in zip(at.tolist(), length.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(low + rows, pa.int64())), pa.array(piece, pa.int32()),
                     pa.array(start, pa.int64()), pa.array(length, pa.int64()),
                     pa.array(crc, pa.int64())], schema.names,
                )

    return map_arrow(keyed, cut, schema)


def fullest(counts: np.ndarray, room: int) -> list[int]:
    """Lengths, each at most as often as counted, that together fill room as far as can be."""
    if room <= 0:
        return []
    mask, target = (1 << (room + 1)) - 1, 1 << room
    # before[i]: the sums reachable before step i. A length that is there m times enters
    # as steps of 1, 2, 4, ... copies, which make up any number to m.
    reach, before, steps = 1, [], []
    for length in range(room, 0, -1):
        left, copies = min(int(counts[length]), room // length), 1
        while left > 0:
            copies = min(copies, left)
            before.append(reach)
            steps.append((length, copies))
            reach |= (reach << (length * copies)) & mask
            left, copies = left - copies, copies * 2
        if reach & target:
            break
    total, out = reach.bit_length() - 1, []
    for (length, copies), sums in zip(reversed(steps), reversed(before)):
        if not sums >> total & 1:
            out += [length] * copies
            total -= length * copies
    return out


def bin_kinds(counts: np.ndarray, most: int) -> list[tuple[int, dict[int, int]]]:
    """(number of bins, length -> copies in each bin), until no length is left.

    counts[l] is the number of pieces of length l, 1 <= l <= most.
    """
    counts, kinds = counts.copy(), []
    for longest in range(most, 0, -1):
        while counts[longest] > 0:
            counts[longest] -= 1
            content: dict[int, int] = {longest: 1}
            for length in fullest(counts, most - longest):
                content[length] = content.get(length, 0) + 1
            counts[longest] += 1
            bins = min(int(counts[length]) // k for length, k in content.items())
            for length, k in content.items():
                counts[length] -= bins * k
            kinds.append((bins, content))
    return kinds


def slots(kinds: list[tuple[int, dict[int, int]]]) -> np.ndarray:
    """Where the pieces of each length go: rows of (length, rank of the first piece,
    copies in a bin, number of the first bin, offset), by length and rank."""
    rows, ranks, number = [], {}, 0
    for bins, content in kinds:
        offset = 0
        for length in sorted(content, reverse=True):
            k = content[length]
            rows.append((length, ranks.get(length, 0), k, number, offset))
            ranks[length] = ranks.get(length, 0) + bins * k
            offset += length * k
        number += bins
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def ranked(pieces: DataFrame, parts: int, *order: str) -> DataFrame:
    """pieces with rank: 0, 1, ... among those of the same length.

    A length that very many pieces have is numbered in `parts` buckets side by side; the
    sizes of the buckets before it are then added to each.
    """
    bucketed = pieces.withColumn(
        "_bucket", F.pmod(F.xxhash64(*order), F.lit(parts)).cast("int")
    )
    numbered = bucketed.withColumn(
        "_rank", F.row_number().over(Window.partitionBy("length", "_bucket").orderBy(*order)) - 1
    )
    sizes = bucketed.groupBy("length", "_bucket").agg(F.count("*").alias("_n"))
    earlier = Window.partitionBy("length").orderBy("_bucket").rowsBetween(
        Window.unboundedPreceding, -1
    )
    before = sizes.select(
        "length", "_bucket", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before")
    )
    return numbered.join(before, ["length", "_bucket"]).withColumn(
        "rank", F.col("_rank") + F.col("_before")
    ).drop("_bucket", "_rank", "_before")


def place(pieces: DataFrame, most: int = SEQUENCE) -> DataFrame:
    """pieces (with length, 1 to `most`) with the sequence and offset of each."""
    spark = pieces.sparkSession
    sizes = pieces.groupBy("length").count().collect()  # at most `most` rows
    counts = np.zeros(most + 1, np.int64)
    for r in sizes:
        counts[r["length"]] = r["count"]
    # At most one kind of bin for each length, each with fewer than 64 different lengths.
    table = spark.sparkContext.broadcast(slots(bin_kinds(counts, most)))
    parts = max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))
    numbered = ranked(pieces, parts, *[c for c in pieces.columns if c != "length"])
    schema = T.StructType([*pieces.schema, T.StructField("sequence_id", T.LongType()),
                           T.StructField("offset", T.LongType())])
    numbered = numbered.select(*pieces.columns, "rank")
    at = pieces.columns.index("length")

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        length, first, copies, number, offset = table.value.T if len(table.value) else [np.empty(0, np.int64)] * 5
        keys = (length << 48) + first
        for batch in batches:
            own = batch.column(at).to_numpy()
            rank = batch.column(batch.num_columns - 1).to_numpy()
            slot = np.searchsorted(keys, (own << 48) + rank, "right") - 1
            nth = rank - first[slot]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(number[slot] + nth // copies[slot]),
                 pa.array(offset[slot] + nth % copies[slot] * own)], schema.names,
            )

    return map_arrow(numbered, look_up, schema)


def pack(
    docs: DataFrame, path: str, key: str = "doc_id", column: str = "text", most: int = SEQUENCE,
) -> DataFrame:
    """One row per piece: key, piece, start, length, ids_crc32, sequence_id, offset.

    A null text counts as empty: its one piece is the closing 0 alone. Repeated rows are
    packed each. A very long text is tokenized by itself, by parts. Columns other than key and
    text are ignored, whatever their names; a null key is kept. An empty table gives an empty
    result.
    """
    return place(staged(cut_pieces(docs, path, key, column, most), "pieces"), most)
