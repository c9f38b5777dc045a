"""WARC archives as chunk tables: pages are written as WARC records and read back.

A payload goes through as rows of (record, chunk number): a long one is cut into segments,
each a WARC record of its own with the digest of the payload so far, so that neither the
writer nor the reader ever holds a whole archive or, when reading, a whole long record. The
writer holds one whole payload, and of its segments at most BATCH_BYTES and one more.
Records with a payload that an earlier record has are revisits and carry none.

Spark's text source does the input and output, with its committer and on any file system:
every record ends with two line ends, which is the line separator in writing, and begins
with the version line, which is the separator in reading. No segment contains the version
line's text, as payloads are also cut inside each occurrence of it.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feira.llm.text import map_arrow
from feira.plans.tables import staged
from feira.session import scratch_path

CHUNK = 64 << 10  # bytes of payload in a segment
BATCH_BYTES = 4 << 20  # of segments that the writer gathers
RECORDS_PER_FILE = 16_384
VERSION = b"WARC/1.1"
END = "\r\n\r\n"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

CHUNK_ROW = (
    "record string, chunk int, page_id long, record_type string, refers_to long, url string, "
    "last boolean, size long, payload_digest string, digest string, data binary"
)
RECORD_ROW = (
    "page_id long, url string, payload_bytes long, payload_digest string, record_type string, "
    "refers_to long, chunks int"
)


def base32_sha1(payload: Column) -> Column:
    """The bare base-32 SHA-1 of a string or binary column."""
    digits = F.sha1(payload.cast("binary"))
    parts = []
    for k in range(8):  # five hexadecimal digits are four of base 32
        number = F.conv(F.substring(digits, 5 * k + 1, 5), 16, 10).cast("int")
        parts += [
            F.substring(F.lit(BASE32), F.shiftright(number, shift).bitwiseAND(31) + 1, 1)
            for shift in (15, 10, 5, 0)
        ]
    return F.concat(*parts)


def with_revisits(pages: DataFrame, key: str, url: str, payload: str) -> DataFrame:
    """page_id, url, payload, payload_digest and, for revisits, refers_to: the smallest
    page_id with an equal payload. A null payload is empty."""
    text = F.coalesce(F.col(f"`{payload}`").cast("string"), F.lit(""))
    pages = pages.select(
        F.col(f"`{key}`").cast("long").alias("page_id"), F.col(f"`{url}`").cast("string").alias("url"),
        text.alias("payload"), base32_sha1(text).alias("payload_digest"),
    )
    equal = pages.groupBy("payload_digest").agg(
        F.min("page_id").alias("first_page"), F.count("*").alias("copies")
    ).where("copies > 1").drop("copies")
    # Written first, so that Spark knows its size: pages are shuffled only if it is large.
    joined = pages.join(staged(equal, "equal-payloads"), "payload_digest", "left")
    revisit = F.when(F.col("page_id").isNull() | (F.col("page_id") != F.col("first_page")), F.col("first_page"))
    return joined.select("page_id", "url", "payload", "payload_digest", revisit.alias("refers_to"))


def cuts(payload: bytes, most: int) -> list[int]:
    """Where a payload is cut, from 0 to its length: between characters, after at most
    about `most` bytes, and inside each occurrence of the version line's text."""
    points = {0, len(payload)}
    points.update(m.start() + 5 for m in re.finditer(re.escape(VERSION), payload))
    last, out = 0, [0]
    for point in sorted(points)[1:]:
        while point - last > most:
            last += most
            while last < point and payload[last] & 0xC0 == 0x80:
                last += 1
            if last < point:
                out.append(last)
        out.append(point)
        last = point
    return out if len(out) > 1 else [0, 0]


def header(fields: list[tuple[str, object]]) -> bytes:
    lines = [f"{k}: {v}" for k, v in fields if v is not None]
    return VERSION + b"\r\n" + "\r\n".join(lines).encode() + b"\r\n\r\n"


def base32(digest: hashlib._Hash) -> str:
    return base64.b32encode(digest.digest()).decode()


def segments(
    name: str, page_id: int | None, url: str | None, payload: bytes, payload_digest: str,
    refers_to: int | None, date: str, most: int,
) -> Iterator[bytes]:
    """The WARC records of one page, without the line ends that close them."""
    uri = None if url is None else re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)
    common = [("WARC-Date", date), ("WARC-Target-URI", uri), ("X-Page-Id", page_id)]
    if refers_to is not None:
        yield header([
            ("WARC-Type", "revisit"), ("WARC-Record-ID", f"<{name}>"), *common,
            ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
            ("WARC-Payload-Digest", f"sha1:{payload_digest}"), ("X-Refers-To-Page-Id", refers_to),
            ("X-Payload-Length", len(payload)),
            ("Content-Type", "application/http;msgtype=response"), ("Content-Length", len(HTTP)),
        ]) + HTTP
        return
    points, so_far = cuts(payload, most), hashlib.sha1()
    for k, (start, end) in enumerate(zip(points, points[1:]), 1):
        part = payload[start:end]
        so_far.update(part)
        block = HTTP + part if k == 1 else part
        whole, final = len(points) == 2, k == len(points) - 1
        yield header([
            ("WARC-Type", "response" if k == 1 else "continuation"),
            ("WARC-Record-ID", f"<{name}>" if k == 1 else f"<{name}-{k}>"), *common,
            ("WARC-Segment-Number", None if whole else k),
            ("WARC-Segment-Origin-ID", None if k == 1 else f"<{name}>"),
            ("WARC-Segment-Total-Length", len(HTTP) + len(payload) if final and not whole else None),
            ("WARC-Payload-Digest", f"sha1:{payload_digest}"),
            ("X-Digest-So-Far", None if whole else f"sha1:{base32(so_far)}"),
            ("Content-Type", "application/http;msgtype=response" if k == 1 else None),
            ("Content-Length", len(block)),
        ]) + block


def gathered(records: Iterator[bytes], most: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """Batches of records, each ended once it has `most` bytes."""
    out, size = [], 0

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(out, pa.large_binary()).cast(pa.string())], ["value"])

    for record in records:
        out.append(record)
        size += len(record)
        if size >= most:
            yield batch()
            out, size = [], 0
    if out:
        yield batch()


def write_archives(
    pages: DataFrame, path: str, key: str = "page_id", url: str = "url", payload: str = "html",
    date: str = "2024-01-01T00:00:00Z", chunk: int = CHUNK,
) -> None:
    """Write a WARC record per row into compressed archives below path.

    Of rows with equal payloads those with the smallest key are responses, the others
    revisits. A null key counts as larger than all; a null payload is empty. Repeated rows
    are written each; other columns are ignored, whatever their names. An empty table
    gives archives without records.
    """
    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[bytes]:
        task, row = TaskContext.get().partitionId(), 0
        for batch in batches:
            payloads = batch.column(2)
            for i in range(batch.num_rows):
                page, target, digest, refers = (batch.column(k)[i].as_py() for k in (0, 1, 3, 4))
                name = uuid.uuid5(uuid.NAMESPACE_URL, f"{task}/{row}/{page}/{digest}").urn
                data = payloads[i].as_buffer().to_pybytes()
                yield from segments(name, page, target, data, digest, refers, date, chunk)
                row += 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return gathered(records(batches))

    marked = with_revisits(pages, key, url, payload)
    map_arrow(marked, run, "value string").write.option("lineSep", END).option(
        "compression", "gzip"
    ).option("maxRecordsPerFile", RECORDS_PER_FILE).text(path)


def parsed(record: bytes) -> tuple:
    """A CHUNK_ROW of a record, which begins behind its version line."""
    head, _, rest = record.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n"))
    length = int(fields["Content-Length"])
    if len(rest) < length:
        raise ValueError(f"record {fields.get('WARC-Record-ID')} is cut short")
    block, kind = rest[:length], fields["WARC-Type"]
    number = int(fields.get("WARC-Segment-Number", 1))
    data = block.partition(b"\r\n\r\n")[2] if number == 1 else block
    digest = fields.get("X-Digest-So-Far")
    last = digest is None or "WARC-Segment-Total-Length" in fields
    as_int = lambda name: int(fields[name]) if name in fields else None
    own = size = None
    if kind == "revisit":
        own, size, data = fields["WARC-Payload-Digest"], as_int("X-Payload-Length"), None
    elif digest is None:  # whole: nothing to wait for
        own, size, data = "sha1:" + base32(hashlib.sha1(data)), len(data), None
    return (
        fields.get("WARC-Segment-Origin-ID", fields["WARC-Record-ID"]), number, as_int("X-Page-Id"),
        kind, as_int("X-Refers-To-Page-Id"), fields.get("WARC-Target-URI"), last, size,
        fields["WARC-Payload-Digest"].removeprefix("sha1:"), (own or digest).removeprefix("sha1:"), data,
    )


def read_chunks(spark: SparkSession, path: str) -> DataFrame:
    """The chunk table of the archives below path: a row per record and segment, the data
    only of records in several segments."""
    arrow = pa.schema([
        ("record", pa.string()), ("chunk", pa.int32()), ("page_id", pa.int64()),
        ("record_type", pa.string()), ("refers_to", pa.int64()), ("url", pa.string()),
        ("last", pa.bool_()), ("size", pa.int64()), ("payload_digest", pa.string()),
        ("digest", pa.string()), ("data", pa.binary()),
    ])

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                values = batch.column(0).slice(low, 256).cast(pa.large_binary())
                rows = [parsed(r) for r in values.to_pylist() if r]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[k] for r in rows], f.type) for k, f in enumerate(arrow)], schema=arrow
                )

    lines = spark.read.option("lineSep", VERSION.decode() + "\r\n").text(path)
    return map_arrow(lines, parse, CHUNK_ROW)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """A row per page of the archives: RECORD_ROW. Digests are those of the payloads read,
    built up chunk by chunk, and checked against what the records carry."""
    arrow = pa.schema([
        ("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
        ("chunks", pa.int32()),
    ])

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        record, so_far, size, first = None, None, 0, None
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                if r["chunk"] == 1:
                    if record is not None:
                        raise ValueError(f"record {record} has no last segment")
                    record, so_far, size, first, expected = r["record"], hashlib.sha1(), 0, r, 1
                if r["record"] != record or r["chunk"] != expected:
                    raise ValueError(f"record {r['record']} lacks a segment before {r['chunk']}")
                digest = r["digest"]
                if r["data"] is not None:
                    so_far.update(r["data"])
                    size += len(r["data"])
                    digest = base32(so_far)
                if digest != r["digest"] or r["last"] and digest != r["payload_digest"]:
                    raise ValueError(f"record {record} does not have the payload that it says")
                expected += 1
                if r["last"]:
                    out.append((
                        first["page_id"], first["url"], size if r["size"] is None else r["size"],
                        digest, first["record_type"], first["refers_to"], r["chunk"],
                    ))
                    record = None
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[k] for r in out], f.type) for k, f in enumerate(arrow)], schema=arrow
            )
        if record is not None:
            raise ValueError(f"record {record} has no last segment")

    chunks = read_chunks(spark, path)
    return map_arrow(
        chunks.repartition("record").sortWithinPartitions("record", "chunk"), fold, RECORD_ROW
    )


def round_trip(pages: DataFrame, **names: str) -> DataFrame:
    """pages written as archives into the shared folder and read back."""
    path = scratch_path(pages.sparkSession, "archives")
    write_archives(pages, path, **names)
    return read_archives(pages.sparkSession, path)
