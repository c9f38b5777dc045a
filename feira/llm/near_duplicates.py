"""Near-duplicate documents by ProbMinHash, banding and exact verification.

A document is a set of shingles of five words. Each shingle is a Poisson process of its
weight's rate, whose arrivals fall into random registers; a register keeps the shingle that
arrived first. Two documents agree in a register with the probability that is their
probability Jaccard similarity; as all shingles weigh the same, however often a text repeats
them, that is the Jaccard similarity that is verified. A process is followed only until no register of its
document can still change.

Texts of equal words are one node from the start. Nodes that agree in a whole band of
registers meet in a bucket. Instead of all pairs of a bucket, each node is first compared
with the bucket's most central one; links join nodes to components; and only pairs of
different components that still share a bucket, and whose sketches are alike, are compared
after that. Every link is verified on the exact shingle sets.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feira.llm.text import map_arrow, mix, shingles, slices, words
from feira.plans.tables import staged

SHINGLE = 5
SIMILAR = 0.8
REGISTERS = 512
BANDS, ROWS = 40, 6  # pairs of similarity 0.8 share no band five times in a million
LIKELY = 0.7  # sketches of pairs of similarity 0.8 are less alike three times in a million
FILTER_BITS = 1 << 27  # of the map that spares most texts a shuffle; 16 MB
ARRIVALS = 1 << 18  # arrivals that are drawn at once
ROWS_PER_TASK = 50_000  # of the narrow tables of buckets, links and labels
PAIRS_PER_TASK = 500

_STEP = np.uint64(0x9E3779B97F4A7C15)
_NODE_SALTS = (np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F))


def weighted(h: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each text, all of weight 1."""
    order = np.lexsort((h, text))
    h, text = h[order], text[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (text[1:] != text[:-1])
    at = np.flatnonzero(new)
    return h[at], text[at], np.ones(len(at))


def signatures(h: np.ndarray, text: np.ndarray, weight: np.ndarray, n: int, k: int = REGISTERS) -> np.ndarray:
    """(texts, registers): the shingle that arrived first in each register; 0 for a text
    without shingles."""
    first = np.full(n * k, np.inf)
    winner = np.zeros(n * k, np.uint64)
    at, time = np.arange(len(h)), np.zeros(len(h))
    drawn = 0  # arrivals of each process so far
    while len(at):
        steps = max(1, min(ARRIVALS // len(at), 256))
        for low in range(0, len(at), ARRIVALS):
            some = at[low:low + ARRIVALS]
            serial = np.arange(drawn + 1, drawn + steps + 1, dtype=np.uint64) * _STEP
            bits = mix(h[some][:, None] + serial)
            # 40 bits give the waiting time, 24 the register.
            wait = -np.log(((bits >> np.uint64(24)).astype(np.float64) + 0.5) * 2.0**-40)
            arrival = time[some][:, None] + np.cumsum(wait / weight[some][:, None], axis=1)
            register = ((bits & np.uint64(0xFFFFFF)) * np.uint64(k) >> np.uint64(24)).astype(np.int64)
            cell = (text[some][:, None] * k + register).ravel()
            flat = arrival.ravel()
            np.minimum.at(first, cell, flat)
            won = flat == first[cell]
            winner[cell[won]] = np.repeat(h[some], steps)[won]
            time[some] = arrival[:, -1]
        drawn += steps
        last = first.reshape(n, k).max(axis=1)
        at = at[time[at] < last[text[at]]]
    return winner.reshape(n, k)


def band_keys(signature: np.ndarray) -> np.ndarray:
    """(texts, bands): a hash of each band's registers and number."""
    rows = signature[:, :BANDS * ROWS].reshape(len(signature), BANDS, ROWS)
    key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), rows.shape[:2])
    for r in range(ROWS):
        key = mix(key * _STEP + rows[:, :, r])
    return key.astype(np.int64)


def sketches(signature: np.ndarray) -> np.ndarray:
    """(texts, REGISTERS / 32): two bits of each register."""
    bits = mix(signature + _STEP) >> np.uint64(62)
    bits = np.stack([bits & np.uint64(1), bits >> np.uint64(1)], axis=2).astype(np.uint8)
    packed = np.packbits(bits.reshape(len(signature), -1), axis=1, bitorder="little")
    return packed.view("<i8").reshape(len(signature), -1)


def nodes(w) -> list[bytes]:
    """16 bytes for each text that only texts of the same words share."""
    count = np.diff(w.first)
    place = np.arange(len(w.hashes)) - np.repeat(w.first[:-1], count)
    halves = []
    for salt in _NODE_SALTS:
        sums = np.zeros(len(w.hashes) + 1, np.uint64)
        np.cumsum(mix(w.hashes + mix(place.astype(np.uint64) + salt)), out=sums[1:])
        halves.append(sums[w.first[1:]] - sums[w.first[:-1]])
    halves[0] += count.astype(np.uint64)
    data = np.stack(halves, axis=1).astype("<u8").tobytes()
    return [data[16 * i:16 * i + 16] for i in range(len(count))]


def signed(docs: DataFrame) -> DataFrame:
    """(key, text_hash, size, node, bands, sketch) for each prepared row. A text without
    words has no bands."""
    kind = docs.schema["key"].dataType.simpleString()
    own = docs.select("key", "text_hash", "size", "text")
    names = ["key", "text_hash", "size", "node", "bands", "sketch"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, data, offsets in slices(batch.column(3)):
                w = words(data, offsets)
                signature = signatures(*weighted(*shingles(w, SHINGLE)), high - low)
                some = np.diff(w.first) > 0
                bands = [b.tolist() if s else [] for b, s in zip(band_keys(signature), some)]
                yield pa.RecordBatch.from_arrays([
                    *[c.slice(low, high - low) for c in batch.columns[:3]], pa.array(nodes(w), pa.binary()),
                    pa.array(bands, pa.list_(pa.int64())),
                    pa.array(list(sketches(signature)), pa.list_(pa.int64())),
                ], names)

    return map_arrow(
        own, run, f"key {kind}, text_hash long, size int, node binary, bands array<long>, sketch array<long>"
    )


def alike(a: Column, b: Column) -> Column:
    """Similarity that two sketches speak for: bits of different registers agree once in four."""
    differ = F.lit(0)
    for i in range(REGISTERS // 32):
        x = F.get(a, F.lit(i)).bitwiseXOR(F.get(b, F.lit(i)))
        differ = differ + F.bit_count(x.bitwiseOR(F.shiftright(x, 1)).bitwiseAND(F.lit(0x5555555555555555)))
    return 1 - differ / F.lit(0.75 * REGISTERS)


def in_few(df: DataFrame, rows: int, per_task: int = ROWS_PER_TASK) -> DataFrame:
    """df in as many partitions as that many rows need; more partitions stay as they are
    only if there are fewer of them."""
    return df.coalesce(1 + rows // per_task)


def similarity(pairs: DataFrame) -> DataFrame:
    """Pairs with columns text_a and text_b replaced by the Jaccard similarity of their
    shingle sets."""
    kept = pairs.drop("text_a", "text_b")
    names, n = [*kept.columns, "similarity"], len(kept.columns)
    schema = T.StructType([*kept.schema, T.StructField("similarity", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 64):
                some = batch.slice(low, 64)
                sides = []
                for column in (n, n + 1):
                    hashes, rows = [], []
                    for lo, _, data, offsets in slices(some.column(column)):
                        h, text, _ = weighted(*shingles(words(data, offsets), SHINGLE))
                        hashes.append(h)
                        rows.append(text + lo)
                    sides.append((np.concatenate(hashes), np.concatenate(rows)))
                h, row = (np.concatenate(x) for x in zip(*sides))
                order = np.lexsort((h, row))
                h, row = h[order], row[order]
                both = (h[1:] == h[:-1]) & (row[1:] == row[:-1])
                shared = np.bincount(row[1:][both], minlength=some.num_rows)
                total = np.bincount(row, minlength=some.num_rows)
                value = shared / np.maximum(total - shared, 1)
                yield pa.RecordBatch.from_arrays([*some.columns[:n], pa.array(value)], names)

    return map_arrow(pairs.select(*kept.columns, "text_a", "text_b"), run, schema)


def components(links: DataFrame) -> DataFrame:
    """(node, label) for the nodes of links (a, b): the smallest node of each component.

    Every round takes the smallest label among a node's neighbours and then that label's
    own label, so the number of rounds grows with the logarithm of a component's length.
    """
    links = staged(links, "links")
    rows = 2 * links.count()
    both = links.select("a", "b").union(links.select(F.col("b"), F.col("a"))).toDF("node", "near")
    labels = in_few(both.groupBy("node").agg(F.min("near").alias("near")), rows).select(
        "node", F.least("node", "near").alias("label")
    )
    labels = staged(labels, "labels")
    while True:
        near = labels.toDF("near", "offer")
        offered = in_few(both.join(near, "near"), rows).groupBy("node").agg(F.min("offer").alias("offer"))
        lower = in_few(labels.join(offered, "node"), rows).select(
            "node", "label", F.least("label", "offer").alias("next")
        )
        far = labels.toDF("next", "far")
        lowest = F.least("next", "far")
        new = staged(in_few(lower.join(far, "next"), rows).select(
            "node", lowest.alias("label"), (lowest < F.col("label")).alias("moved")
        ), "labels")
        labels = new.select("node", "label")
        if new.where("moved").isEmpty():
            return labels


def verified(pairs: DataFrame, texts: DataFrame, similar: float) -> DataFrame:
    """The pairs (a, b) of at least the given similarity."""
    n = pairs.count()
    half = in_few(pairs.join(texts.toDF("b", "text_b"), "b"), n, PAIRS_PER_TASK)
    full = in_few(half.join(texts.toDF("a", "text_a"), "a"), n, PAIRS_PER_TASK)
    return similarity(full).where(F.col("similarity") >= similar).drop("similarity")


def possibly(rows: DataFrame, wanted: DataFrame, hashed: str) -> DataFrame:
    """rows with a column _maybe: false where the hash is not among the wanted. A map of
    bits, of fixed size however many are wanted, tells so; it only saves work."""
    bit = F.pmod(F.col(hashed), F.lit(FILTER_BITS))
    bits = wanted.groupBy(F.bitmap_bucket_number(bit).alias("_part")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("_bits")
    )
    at = F.bitmap_bit_position(bit)
    byte = F.conv(F.hex(F.substring("_bits", F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    inside = byte.bitwiseAND(F.call_function("shiftleft", F.lit(1), (at % 8).cast("int"))) != 0
    found = rows.join(F.broadcast(bits), F.bitmap_bucket_number(bit) == F.col("_part"), "left")
    return found.select(*[F.col(f"`{c}`") for c in rows.columns], F.coalesce(inside, F.lit(False)).alias("_maybe"))


def prepared(docs: DataFrame, key: str, column: str) -> DataFrame:
    """(key, text) of docs with what tells rows apart without their texts."""
    own = docs.select(F.col(f"`{key}`").alias("key"), F.coalesce(F.col(f"`{column}`"), F.lit("")).alias("text"))
    return own.select(
        "key", "text", F.xxhash64("text").alias("text_hash"), F.octet_length("text").alias("size")
    )


def smallest_row() -> Column:
    """The row of smallest key of a group; a null key counts as larger than all."""
    return F.min(F.struct(F.col("key").isNull().alias("no_key"), "key", "text_hash", "size"))


def is_row(a: DataFrame, b: DataFrame) -> Column:
    return (a["text_hash"] == b["text_hash"]) & (a["size"] == b["size"]) & a["key"].eqNullSafe(b["key"])


def labelled(own: DataFrame, similar: float) -> tuple[DataFrame, DataFrame]:
    """For prepared rows (key, text_hash, size, node), and the label of each node's class."""
    every = staged(signed(own), "signatures")
    # One row for each node: that of the smallest key.
    smallest = F.min(F.struct(
        F.col("key").isNull().alias("no_key"), "key", "text_hash", "size", "bands", "sketch"
    ))
    one = staged(every.groupBy("node").agg(smallest.alias("row")).select("node", "row.*"), "nodes")

    # Buckets of several nodes, and how many others each node meets in all its buckets.
    entries = one.select("node", F.posexplode("bands").alias("band", "bucket"))
    shared = entries.groupBy("bucket").agg(F.count("*").alias("members")).where("members > 1")
    entries = staged(entries.join(shared, "bucket"), "entries")
    rows = entries.count()
    central = in_few(entries.groupBy("node").agg(F.sum("members").alias("central")), rows)
    wanted = staged(in_few(one.drop("no_key").join(central, "node"), rows), "wanted")
    ranked = entries.drop("members").join(wanted.select("node", "central", "bands", "sketch"), "node")
    ranked = staged(in_few(ranked, rows), "ranked")

    # First each node with the most central one of each of its buckets.
    top = F.max(F.struct("central", "node", "sketch")).alias("top")
    tops = in_few(ranked.groupBy("bucket").agg(top), rows)
    met = in_few(ranked.join(tops, "bucket"), rows).where(
        (F.col("node") != F.col("top.node")) & (alike(F.col("sketch"), F.col("top.sketch")) >= LIKELY)
    )
    stars = staged(in_few(met.select(
        F.col("top.node").alias("a"), F.col("node").alias("b"), F.col("top.central").alias("central")
    ).distinct(), rows), "star-pairs")
    # The wanted grow with the data: they are never broadcast.
    kept = possibly(own, wanted, "text_hash").where("_maybe").drop("_maybe")
    texts = kept.join(
        wanted.drop("central", "bands", "sketch").hint("merge"), is_row(kept, wanted)
    ).select("node", "text").dropDuplicates(["node"])
    texts = staged(texts, "texts")
    links = staged(verified(stars, texts, similar), "star-links")

    # Then what the stars left apart: pairs that share a bucket but no central node.
    nearest = links.groupBy(F.col("b").alias("node")).agg(F.max(F.struct("central", "a")).alias("near"))
    label = F.coalesce("near.a", "node").alias("label")
    apart = in_few(ranked.join(in_few(nearest, rows), "node", "left"), rows).select(*ranked.columns, label)
    several = in_few(apart.groupBy("bucket").agg(
        F.min("label").alias("low"), F.max("label").alias("high"), F.max(F.struct("central", "node")).alias("top")
    ), rows).where("low < high").select("bucket", F.col("top.node").alias("top"))
    live = in_few(apart.join(several, "bucket"), rows).where("node != top").drop("top", "central")
    live = staged(live, "live")
    x, y = live.alias("x"), live.alias("y")
    # A pair that shares several bands counts in the first of them.
    first_shared = F.array_position(
        F.zip_with("x.bands", "y.bands", lambda p, q: p == q), True
    ) == F.col("x.band") + 1
    rest = x.join(y, (F.col("x.bucket") == F.col("y.bucket")) & (F.col("x.label") < F.col("y.label"))
                  & (alike(F.col("x.sketch"), F.col("y.sketch")) >= LIKELY) & first_shared)
    rest = staged(rest.select(F.col("x.node").alias("a"), F.col("y.node").alias("b")), "rest-pairs")
    links = links.select("a", "b").unionByName(verified(rest, texts, similar))

    named = one.select("node").join(components(links), "node", "left").select(
        "node", F.coalesce("label", "node").alias("label")
    )
    return every.select("key", "text_hash", "size", "node"), staged(named, "classes")


def classes(
    docs: DataFrame, key: str = "doc_id", column: str = "text", similar: float = SIMILAR,
) -> DataFrame:
    """One row per document: key and class_id, the smallest key of its class.

    Classes are the components of documents whose sets of five-word shingles have a Jaccard
    similarity of at least `similar`; a text of fewer words, but not none, is one shingle. A
    null text is empty; texts without words are one class. A null key counts as larger than
    all; if no member has a key, class_id is null. Repeated rows are kept. Other columns are
    ignored, whatever their names. A very long text is a slice of its own, and all its shingles
    count. An empty table gives an empty result.
    """
    every, named = labelled(prepared(docs, key, column), similar)
    by_node = every.groupBy("node").agg(F.min("key").alias("key")).join(named, "node")
    smallest = by_node.groupBy("label").agg(F.min("key").alias("class_id"))
    answer = by_node.join(smallest, "label").select("node", "class_id")
    return every.select("key", "node").join(answer, "node").select(F.col("key").alias(key), "class_id")


def deduplicate(
    docs: DataFrame, key: str = "doc_id", column: str = "text", similar: float = SIMILAR,
) -> DataFrame:
    """docs with one row of each class (see classes): that of the smallest key, and of
    several of that key that of the smallest hash of its text. Of repeated rows one stays."""
    every, named = labelled(prepared(docs, key, column), similar)
    rows = every.groupBy("node", "key", "text_hash", "size").agg(F.count("*").alias("copies")).join(named, "node")
    chosen = rows.groupBy("label").agg(smallest_row().alias("row"))
    decided = rows.join(chosen, "label").withColumn(
        "stays", F.col("row").eqNullSafe(F.struct(F.col("key").isNull(), "key", "text_hash", "size"))
    ).where("copies > 1 or not stays").select("key", "text_hash", "size", "stays")
    # Only rows that may be among the decided are shuffled.
    decided = staged(decided, "decided")
    own = [f"c{i}" for i in range(len(docs.columns))]  # clear of the names used here
    k, text = (F.col(own[docs.columns.index(c)]) for c in (key, column))
    text = F.coalesce(text, F.lit(""))
    hashed = docs.toDF(*own).select("*", F.xxhash64(text).alias("_hash"))
    hashed = possibly(hashed, decided.select(F.col("text_hash").alias("_hash")), "_hash")
    decided = decided.toDF("_key", "_text_hash", "_size", "_stays").hint("merge")
    marked = hashed.where("_maybe").join(decided, (
        (F.col("_hash") == F.col("_text_hash")) & (F.octet_length(text) == F.col("_size")) & k.eqNullSafe(F.col("_key"))
    ), "left")
    several = marked.where("_stays").dropDuplicates(["_key", "_hash", "_size"])
    parts = [hashed.where("not _maybe"), marked.where("_stays is null"), several]
    return reduce(DataFrame.unionByName, [p.select(*own) for p in parts]).toDF(*docs.columns)
