"""Fill-in-middle transformation by secondary sort.

A text is cut into units (runs of ASCII letters, and every other code point), and two hashed
cuts part it into prefix, middle and suffix. Each of the three is emitted in chunks of a
bounded number of units, keyed by document and place in the output. Spark's
repartitionAndSortWithinPartitions brings the chunks of a document together in output order,
where they stream into a running digest. What it takes to restore the text is read off that
output stream alone: its marks say which part a chunk belongs to, the chunks get their place
in the text as a new key, and are sorted anew. As a document stays in its partition, that
second sort moves no data; both sorts spill to disk where a partition outgrows its memory.

The key of a document is its input partition and a digest of id and text, so that rows of
one hot id are spread. Equal rows of one input partition share a key; their chunks are equal
too, of which one is followed and the others are counted.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
from pyspark import RDD
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feira.llm.text import ship

CHUNK = 8192  # units in a chunk
PART_BYTES = 16 << 20  # of text that is sorted in one task, unless one document is longer
SEED = 1
PLAIN_FROM = 90  # of 100: texts from here on stay as they are
SUFFIX_FIRST = 20  # of 100 of the others begin with their suffix
ORDERS = {"plain": "P", "psm": "PSM", "spm": "SPM"}  # of prefix, suffix and middle in the output
PLACES = {"P": 0, "M": 1, "S": 2}  # in the text
MARK = re.compile(rb"<([PSM])>")
LAST = 3  # behind all parts of a text

_LETTER = np.zeros(256, bool)
for _low, _high in ((0x41, 0x5A), (0x61, 0x7A)):
    _LETTER[_low:_high + 1] = True


class Head(NamedTuple):
    """What is known of a document before its chunks."""

    key: object
    n: int
    form: str
    prefix_chars: int | None
    middle_chars: int | None


def unit_starts(data: bytes) -> np.ndarray:
    """The byte where each unit of a UTF-8 text starts."""
    raw = np.frombuffer(data, np.uint8)
    letter = _LETTER[raw]
    start = (raw & 0xC0) != 0x80
    start[1:] &= ~(letter[1:] & letter[:-1])
    return np.flatnonzero(start)


def draws(key: object, seed: int = SEED) -> list[int]:
    """Four numbers of 32 bits; a null key counts as an empty string."""
    digest = hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()
    return [int(digest[k:k + 8], 16) for k in range(0, 32, 8)]


def parts_of(
    key: object, text: str | None, chunk: int = CHUNK, seed: int = SEED,
) -> tuple[Head, Iterator[bytes]]:
    """The head of a document, and the chunks of its output in order."""
    data = (text or "").encode()
    starts = unit_starts(data)
    n, (h1, h2, h3, h4) = len(starts), draws(key, seed)
    ends = np.append(starts, len(data))
    if not n or h3 % 100 >= PLAIN_FROM or MARK.search(data):
        form, cuts = "plain", [0, n]
        head = Head(key, n, form, None, None)
    else:
        form = "spm" if h4 % 100 < SUFFIX_FIRST else "psm"
        cuts = [0, *sorted((h1 % (n + 1), h2 % (n + 1))), n]
        chars = [len(data[ends[a]:ends[b]].decode()) for a, b in zip(cuts[:2], cuts[1:3])]
        head = Head(key, n, form, *chars)

    def chunks() -> Iterator[bytes]:
        for part in ORDERS[form]:
            low, high = cuts[PLACES[part]], cuts[PLACES[part] + 1]
            mark = b"" if form == "plain" else b"<%s>" % part.encode()
            for at in range(low, high, chunk):
                yield mark + data[ends[at]:ends[min(at + chunk, high)]]
                mark = b""
            if mark:  # an empty part
                yield mark

    return head, chunks()


def split_output(form: str, chunks: Iterable[bytes]) -> Iterator[tuple[int, bytes]]:
    """The chunks of an output without marks, each with the place of its part in the text."""
    place = 0
    for data in chunks:
        if form == "plain":
            yield place, data
            continue
        at = 0
        for mark in MARK.finditer(data):
            if mark.start() > at:
                yield place, data[at:mark.start()]
            place, at = PLACES[mark[1].decode()], mark.end()
        if at < len(data):
            yield place, data[at:]


def by_document(key: tuple) -> int:
    """Where the chunks of a document go."""
    return int.from_bytes(key[1][:6], "big")


def documents_of(records: Iterable[tuple]) -> Iterator[tuple[tuple, Iterator[tuple[tuple, object, int]]]]:
    """Sorted records ((partition, digest, place, number), value), grouped by document without
    holding a group: (document, (place, value, copies) ...). Records of one key are copies."""
    records = iter(records)
    ahead = next(records, None)

    def group(document: tuple) -> Iterator[tuple[tuple, object, int]]:
        nonlocal ahead
        while ahead is not None and ahead[0][:2] == document:
            (key, value), copies = ahead, 1
            ahead = next(records, None)
            while ahead is not None and ahead[0] == key:
                copies += 1
                ahead = next(records, None)
            yield key[2:], value, copies

    while ahead is not None:
        document = ahead[0][:2]
        own = group(document)
        yield document, own
        for _ in own:  # what the reader left
            pass


def assembled(
    docs: DataFrame, key: str = "doc_id", column: str = "text", chunk: int = CHUNK, seed: int = SEED,
) -> RDD:
    """Sorted records ((partition, digest, 0, number), chunk) of each document in output
    order; number 0 holds its head."""
    ship(docs.sparkSession)

    def emit(partition: int, rows: Iterator) -> Iterator[tuple]:
        for k, text in rows:
            head, chunks = parts_of(k, text, chunk, seed)
            digest = hashlib.sha256(f"{k!r} ".encode() + (text or "").encode()).digest()[:16]
            yield (partition, digest, 0, 0), head
            for number, data in enumerate(chunks, 1):
                yield (partition, digest, 0, number), data

    size = docs.agg(F.sum(F.octet_length(F.col(f"`{column}`")))).first()[0] or 0
    rows = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{column}`").alias("text")).rdd
    return rows.mapPartitionsWithIndex(emit).repartitionAndSortWithinPartitions(
        max(8, -(-size // PART_BYTES)), by_document
    )


def outputs(
    docs: DataFrame, key: str = "doc_id", column: str = "text", chunk: int = CHUNK, seed: int = SEED,
) -> DataFrame:
    """The transformed texts: key, form, number, output. The outputs of a document in the
    order of their numbers (0, 1, ...) are its transformed text, of at most `chunk` units each.

    Nulls, empty texts, repeated rows and other columns as in `digests`; an empty text has no
    row here.
    """
    schema = T.StructType([
        T.StructField(key, docs.schema[key].dataType), *T.StructType.fromDDL("form string, number int, output string"),
    ])

    def rows(records: Iterator[tuple]) -> Iterator[tuple]:
        for _, own in documents_of(records):
            _, head, _ = next(own)
            for (_, number), data, copies in own:
                for _ in range(copies):
                    yield head.key, head.form, number - 1, data.decode()

    found = assembled(docs, key, column, chunk, seed).mapPartitions(rows)
    return docs.sparkSession.createDataFrame(found, schema)


def digests(
    docs: DataFrame, key: str = "doc_id", column: str = "text", chunk: int = CHUNK, seed: int = SEED,
) -> DataFrame:
    """key, n (units), form, prefix_chars, middle_chars, output_sha256, restored_sha256.

    The last is the digest of the text that is rebuilt from the output and its form. A null
    text counts as empty, whose form is plain; a null key is kept and drawn for as an empty
    string. Repeated rows give a row each. A very long text goes through in chunks. Other
    columns are ignored, whatever their names. An empty table gives an empty result.
    """
    schema = T.StructType([
        T.StructField(key, docs.schema[key].dataType),
        *T.StructType.fromDDL(
            "n long, form string, prefix_chars long, middle_chars long, output_sha256 string, restored_sha256 string"
        ),
    ])

    def read_back(records: Iterator[tuple]) -> Iterator[tuple]:
        """Digests the outputs, and gives each chunk its place in the text."""
        for document, own in documents_of(records):
            _, head, copies = next(own)
            sha = hashlib.sha256()

            def output() -> Iterator[bytes]:
                for _, data, _ in own:
                    sha.update(data)
                    yield data

            for number, (place, data) in enumerate(split_output(head.form, output())):
                yield (*document, place, number), data
            yield (*document, LAST, 0), (head, sha.hexdigest(), copies)

    def restored(records: Iterator[tuple]) -> Iterator[tuple]:
        for _, own in documents_of(records):
            sha = hashlib.sha256()
            for (place, _), value, _ in own:
                if place < LAST:
                    sha.update(value)
                    continue
                head, digest, copies = value
                for _ in range(copies):
                    yield (*head, digest, sha.hexdigest())

    sorted_once = assembled(docs, key, column, chunk, seed)
    sorted_anew = sorted_once.mapPartitions(read_back, preservesPartitioning=True).repartitionAndSortWithinPartitions(
        sorted_once.getNumPartitions(), by_document
    )
    return docs.sparkSession.createDataFrame(sorted_anew.mapPartitions(restored), schema)
