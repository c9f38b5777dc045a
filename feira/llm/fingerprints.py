"""Document fingerprints by one-permutation MinHash, in DataFrame functions alone.

Every shingle of five words is hashed once. The high bits of the hash choose a bin, and
each bin keeps its smallest hash. An empty bin takes the value of a bin that is not,
probing the others in a random order of its own (optimal densification). The fingerprint
packs the low BITS bits of each bin as hexadecimal digits. Two bins of different values
agree in them once in 2**BITS times, for which the likeness is corrected.
"""

from __future__ import annotations

import json
import math
import random

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feira.llm.text import free_name

SHINGLE = 5
BIN_BITS = 7
BINS = 1 << BIN_BITS
BITS = 8
FIRST_PROBES = 8
WORD = r"([^\x00-\x2F\x3A-\x60\x7B-\x7F]+)"
RANGE_BYTES = 16 << 20  # of text in a range of documents, about; there are SAMPLE ranges at most
SAMPLE = 50_000  # keys from which the borders between buckets are chosen, at most


def probes() -> list[list[int]]:
    """For each bin the others in a random order."""
    rng = random.Random(20170811)
    return [rng.sample([c for c in range(BINS) if c != b], BINS - 1) for b in range(BINS)]


def shingle_hashes(hashes: Column) -> Column:
    """Hashes of SHINGLE consecutive words; of all words, if there are fewer but some."""
    full = F.transform(
        F.sequence(F.lit(0), F.size(hashes) - SHINGLE),
        lambda i: F.xxhash64(*[F.get(hashes, i + k) for k in range(SHINGLE)]),
    )
    short = F.array(F.aggregate(hashes, F.lit(7).cast("long"), lambda done, h: F.xxhash64(done, h)))
    none = F.array().cast("array<bigint>")
    return F.when(F.size(hashes) >= SHINGLE, full).when(F.size(hashes) > 0, short).otherwise(none)


def bin_of(h: Column) -> Column:
    """0 to BINS - 1, in the order of the signed hashes."""
    return (F.shiftright(h, 64 - BIN_BITS) + BINS // 2).cast("int")


def with_fingerprint(df: DataFrame, text: str, name: str) -> DataFrame:
    """df with the fingerprint of a text column. A null text is empty; a text without words
    has the empty fingerprint. Each step is a projection, so that nothing is computed twice."""
    step = free_name([*df.columns, name], "_bins")
    own = F.col(f"`{step}`")
    kept = [F.col(f"`{c}`") for c in df.columns]
    words = F.regexp_extract_all(F.lower(F.coalesce(F.col(f"`{text}`"), F.lit(""))), F.lit(WORD), 1)
    df = df.select(*kept, F.transform(words, lambda w: F.xxhash64(w)).alias(step))
    df = df.select(*kept, F.sort_array(shingle_hashes(own)).alias(step))
    # In sorted order the first hash of each bin is its smallest.
    df = df.select(*kept, F.filter(
        own, lambda h, i: (i == 0) | (bin_of(h) != bin_of(F.get(own, i - 1)))
    ).alias(step))
    df = df.select(*kept, F.struct(
        F.transform(own, bin_of).alias("bins"),
        F.transform(own, lambda h: h.bitwiseAND((1 << BITS) - 1).cast("int")).alias("low"),
    ).alias(step))
    df = df.select(*kept, F.when(F.size(own["bins"]) > 0, F.transform(
        F.sequence(F.lit(0), F.lit(BINS - 1)),
        lambda b: F.get(own["low"], F.array_position(own["bins"], b).cast("int") - 1),
    )).alias(step))
    order = F.from_json(F.lit(json.dumps(probes())), "array<array<int>>")

    def densified(value: Column, b: Column) -> Column:
        def first_of(candidates: Column) -> Column:
            return F.get(F.filter(F.transform(candidates, lambda c: F.get(own, c)), lambda v: v.isNotNull()), F.lit(0))

        probing = F.get(order, b)
        return F.coalesce(value, first_of(F.slice(probing, 1, FIRST_PROBES)), first_of(probing))

    df = df.select(*kept, F.transform(own, densified).alias(step))
    digits = BITS // 4
    packed = F.array_join(F.transform(own, lambda v: F.lpad(F.lower(F.hex(v)), digits, "0")), "")
    return df.select(*kept, F.coalesce(packed, F.lit("")).alias(name))


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard similarity of the shingle sets of two fingerprints, 0 to 1."""
    digits = BITS // 4
    same = F.aggregate(
        F.sequence(F.lit(0), F.lit(BINS - 1)), F.lit(0),
        lambda n, i: n + F.when(
            F.substring(a, i * digits + 1, digits) == F.substring(b, i * digits + 1, digits), 1
        ).otherwise(0),
    )
    chance = 2.0**-BITS
    corrected = F.greatest((same / BINS - chance) / (1 - chance), F.lit(0.0))
    return F.when(a == b, 1.0).when((a == "") | (b == ""), 0.0).otherwise(corrected)


def borders(df: DataFrame, key: str, buckets: int) -> tuple[list, object, bool]:
    """Keys at which buckets of about equal size begin, the smallest key, and whether any
    key is null. The borders come from a sample of bounded size; any would do."""
    stats = df.agg(F.count("*").alias("n"), F.min(key).alias("low"), F.count(key).alias("keys")).first()
    if not stats["keys"]:
        return [], None, stats["n"] > 0
    share = min(1.0, SAMPLE / 2 / stats["keys"])
    sample = df.select(key).where(F.col(key).isNotNull()).sample(share, seed=4).limit(SAMPLE)
    keys = sorted(r[0] for r in sample.collect())
    chosen = sorted({keys[len(keys) * k // buckets] for k in range(1, buckets)}) if keys else []
    return [k for k in chosen if k > stats["low"]], stats["low"], stats["keys"] < stats["n"]


def bucket_of(key: Column, limits: list, kind: str) -> Column:
    """How many of the sorted limits are at most key, by binary search; 0 for a null."""
    if not limits:
        return F.lit(0)
    table = F.from_json(F.lit(json.dumps(limits)), f"array<{kind}>")
    steps = [1 << k for k in reversed(range(max(1, math.ceil(math.log2(len(limits) + 1)))))]
    return F.aggregate(
        F.array(*[F.lit(s) for s in steps]), F.lit(0),
        lambda low, s: F.when(F.get(table, low + s - 1) <= key, low + s).otherwise(low),
    )


def with_next(df: DataFrame, key: str, values: list[str], tie: str, buckets: int) -> DataFrame:
    """df with next_<value>, for each of values that of the row that follows by ascending key (an
    integer; nulls come first, equal keys go by the tie column); after the last, the first.

    Rows are dealt to buckets by ranges of the key. The rows with the first key of each
    bucket are also sent to the bucket before it, to end it, and those with the first key
    of all to the last bucket. So one shuffle does, and no task holds more than a bucket.
    """
    limits, low, nulls = borders(df, key, buckets)
    kind = df.schema[key].dataType.simpleString()
    own, at = F.col(key), free_name(df.columns, "_bucket")
    bucket = bucket_of(own, limits, kind)
    first = own.isNull() if nulls else own == F.lit(low)
    begins = F.get(F.from_json(F.lit(json.dumps(limits)), f"array<{kind}>"), bucket - 1) == own
    copies = F.concat(
        F.array(F.struct(bucket.alias("bucket"), F.lit(0).alias("extra"))),
        F.when(F.coalesce(begins, F.lit(False)), F.array(F.struct((bucket - 1).alias("bucket"), F.lit(1).alias("extra")))).otherwise(F.array()),
        F.when(F.coalesce(first, F.lit(False)), F.array(F.struct(F.lit(len(limits)).alias("bucket"), F.lit(2).alias("extra")))).otherwise(F.array()),
    )
    dealt = df.select("*", F.inline(copies).alias("_to", "_extra"))
    follows = Window.partitionBy("_to").orderBy("_extra", F.col(key).asc_nulls_first(), tie)
    following = {f"next_{v}": F.lead(v).over(follows) for v in values}
    return dealt.withColumns(following).where("_extra = 0").drop("_to", "_extra")


def fingerprint_edits(
    docs: DataFrame, key: str = "doc_id", column: str = "text", buckets: int | None = None,
) -> DataFrame:
    """key, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next
    for each document and its edited text: its second half (the last n_chars // 2 code
    points) replaced by as many from the start of the next document.

    A null text is empty; a very long one is handled whole, like any other. Repeated keys are
    ordered by their text. Other columns are ignored, whatever their names; an empty table
    gives an empty result. The number of ranges follows from the bytes of all texts, so that a
    range holds as much whatever the size of the table.
    """
    spark = docs.sparkSession
    if buckets is None:
        size = docs.agg(F.sum(F.octet_length(F.col(f"`{column}`")))).first()[0] or 0
        buckets = max(4 * int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // RANGE_BYTES))
    own = docs.select(
        F.col(f"`{key}`").alias("key"), F.coalesce(F.col(f"`{column}`"), F.lit("")).alias("text")
    )
    marked = with_fingerprint(own, "text", "fingerprint")
    # The borders need the keys alone.
    paired = with_next(marked, "key", ["text", "fingerprint"], "text", buckets)
    length = F.char_length("text")
    half = F.floor(length / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), length - half), F.substring("next_text", F.lit(1), half))
    changed = paired.select(
        "key", length.cast("long").alias("n_chars"), "fingerprint",
        "next_fingerprint", edited.alias("edited"),
    )
    changed = with_fingerprint(changed, "edited", "edited_fingerprint")
    return changed.select(
        F.col("key").alias(key), "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
        "fingerprint", "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"),
    )
