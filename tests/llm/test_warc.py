import gzip
import os

import brute
import pytest

from feira.llm import warc
from feira.llm.queries import QUERIES
from feira.session import scratch_path

PAGES = [
    (1, "u", "a"), (2, None, None), (3, "x\r\ny", ""), (4, "u", "WARC/1.1\r\nWARC-Type: x\r\n\r\nWARC/1.1"),
    (5, "é ü", "é€😀" * 50000), (5, "é ü", "é€😀" * 50000), (None, "n", "a"), (None, "n", "b"), (6, "q", "\r\n\r\n"),
    (7, "q", "WARC/1.1"), (9, "q", "é€😀" * 50000), (10, "", "\r\n"), (11, "", "x" * 65536), (12, "", "x" * 65537),
]
SCHEMA = "page_id long, url string, html string"


def rows_of(df):
    names = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    return sorted((tuple(r) for r in df.select(*names).collect()), key=repr)


@pytest.mark.parametrize("chunk", [warc.CHUNK, 7])
def test_round_trip(frame, spark, chunk):
    path = scratch_path(spark, "warc-test")
    warc.write_archives(frame(PAGES, SCHEMA).repartition(3), path, chunk=chunk)
    assert rows_of(warc.read_archives(spark, path)) == sorted(brute.records(PAGES), key=repr)


def test_long_payloads_are_rows_of_chunks(frame, spark):
    path = scratch_path(spark, "warc-test")
    warc.write_archives(frame(PAGES, SCHEMA), path, chunk=1000)
    chunks = warc.read_chunks(spark, path).where("page_id = 9 or page_id = 5").collect()
    whole = [c for c in chunks if c.record_type != "revisit"]
    assert max(len(c.data) for c in whole) <= 1003
    for record in {c.record for c in whole}:
        own = sorted((c for c in whole if c.record == record), key=lambda c: c.chunk)
        assert b"".join(c.data for c in own).decode() == PAGES[4][2]
        assert own[-1].last and own[-1].digest == own[0].payload_digest


def test_writer_gathers_few_bytes():
    """The segments of a long payload are passed on while the rest is still to be cut."""
    cut = []

    def records():
        for record in warc.segments("n", 1, "u", b"x" * 100_000, "X", None, "d", 1000):
            cut.append(len(record))
            yield record

    batches = warc.gathered(records(), 10_000)
    assert next(batches).num_rows == len(cut) < 10
    rest = list(batches)
    assert len(cut) == 100 and all(b.nbytes < 12_000 for b in rest) and list(warc.gathered(iter([]))) == []


def test_archives_are_warc(frame, spark):
    path = scratch_path(spark, "warc-test")
    warc.write_archives(frame(PAGES[:1], SCHEMA).coalesce(1), path)
    name = next(f for f in os.listdir(path) if f.endswith(".gz"))
    data = gzip.open(f"{path}/{name}").read()
    assert data.startswith(b"WARC/1.1\r\nWARC-Type: response\r\n") and data.endswith(b"\r\n\r\na\r\n\r\n")


def test_damage_is_found():
    good = list(warc.segments("n", 1, "u", b"abcdef", "X", None, "d", 3))
    with pytest.raises(ValueError):
        warc.parsed(good[0].removeprefix(warc.VERSION + b"\r\n")[:-1])


def test_empty_table(frame, spark):
    assert warc.round_trip(frame([], SCHEMA)).count() == 0


def test_all_pages(spark, sf_dir, table):
    want = sorted(brute.records(table("pages", "page_id", "url", "html")), key=repr)
    assert rows_of(QUERIES["op3_warc"](spark, sf_dir)) == want
