"""Archives written and read back, against the pages they hold."""

from __future__ import annotations

import gzip
import hashlib
import io

from tickloom.llm.op4_warc import (
    header,
    op4_warc,
    page_records,
    read_archives,
    record,
    records,
    write_archives,
)
from tickloom.session import scratch

SMALL = "/root/testdata/sf0.001"
EVERYTHING = lambda fields: (True, True)


def archive(tmp_path, name, data):
    (tmp_path / name).write_bytes(data)
    return f"file://{tmp_path}"


def row(i, payload, kind="response"):
    return {
        "record_type": kind,
        "record_id": f"<urn:page:{i}>",
        "target_uri": f"http://x/{i}",
        "payload_length": len(payload),
        "payload": payload,
    }


def test_records_are_gzip_members_that_any_tool_reads():
    rows = [row(1, b"a" * 300), row(2, b""), row(3, b"\r\n\r\nx\x00\xff" * 5000), row(4, b"r" * 500, "revisit")]
    data = b"".join(map(record, rows))
    plain = gzip.decompress(data)
    for packed, source in ((True, data), (False, plain)):
        found = list(records(io.BytesIO(source), packed, EVERYTHING))
        assert [f["warc-type"] for f, _ in found] == ["response"] * 3 + ["revisit"]
        assert [b.partition(b"\r\n\r\n")[2] for _, b in found] == [r["payload"] for r in rows[:3]] + [b""]


def test_members_without_sizes_and_folded_headers():
    head = b"WARC/1.0\r\nWARC-Type: metadata\r\nX-Long: one\r\n two\r\nContent-Length: 5\r\n\r\n"
    data = gzip.compress(head + b"hello\r\n\r\n") + gzip.compress(header({"WARC-Type": "x", "Content-Length": 0}) + b"\r\n\r\n")
    found = list(records(io.BytesIO(data), True, EVERYTHING))
    assert found[0][0]["x-long"] == "one two" and found[0][1] == b"hello"
    assert [f["warc-type"] for f, _ in found] == ["metadata", "x"]


def test_unwanted_blocks_are_not_decoded():
    class Counting(io.BytesIO):
        got = 0

        def read(self, n=-1):
            data = super().read(n)
            Counting.got += len(data)
            return data

    import os

    big = os.urandom(8 << 20)
    data = record(row(1, big)) + record(row(2, b"z" * 200, "revisit"))
    found = list(records(Counting(data), True, lambda f: (f["warc-type"] == "revisit", False)))
    assert [b for _, b in found] == [None] and Counting.got < 3 << 20


def test_filters_reach_the_source(spark, tmp_path):
    folder = archive(tmp_path, "a.warc.gz", record(row(1, b"q" * 200)) + record(row(2, b"w" * 300)))
    archive(tmp_path, "b.warc", gzip.decompress(record(row(3, b"q" * 200, "revisit"))))
    read = read_archives(spark, folder, "record_type string, record_id string, payload_length long")
    assert read.count() == 3
    got = read.filter("record_type = 'response' and record_id in ('<urn:page:2>', '<urn:page:3>')")
    assert "PushedFilters: [EqualTo" in got._jdf.queryExecution().executedPlan().toString() or got.count() == 1
    assert [tuple(r) for r in got.collect()] == [("response", "<urn:page:2>", 300)]


def test_nulls_ties_short_payloads_and_empty(spark):
    long, short = "é" * 60, "tiny"
    rows = [(5, "u", long), (3, "u", long), (None, None, long), (4, None, short), (6, "a\r\nb", short), (7, "u", None), (3, "u", long)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    folder = scratch(spark, "t")
    write_archives(page_records(pages, "page_id", "url", "html"), folder)
    got = read_archives(spark, folder, "record_type string, record_id string, refers_to_id string, payload_length long").collect()
    kinds = sorted((r.record_id, r.record_type, r.refers_to_id, r.payload_length) for r in got)
    first = "<urn:page:3>"
    assert kinds == [
        ("<urn:page:3>", "response", None, 120),
        ("<urn:page:3>", "response", None, 120),
        ("<urn:page:4>", "response", None, 4),
        ("<urn:page:5>", "revisit", first, 120),
        ("<urn:page:6>", "response", None, 4),
        ("<urn:page:7>", "response", None, 0),
        ("<urn:page:>", "revisit", first, 120),
    ]
    empty = scratch(spark, "t")
    write_archives(page_records(pages.limit(0), "page_id", "url", "html"), empty)
    assert read_archives(spark, empty, "record_type string").collect() == []


def test_query(spark):
    pages = spark.read.parquet(f"{SMALL}/pages.parquet").collect()
    first = {}
    for p in sorted(pages, key=lambda p: p.page_id):
        first.setdefault(p.html or "", p.page_id)
    got = {r.page_id: r for r in op4_warc(spark, SMALL).collect()}
    assert len(got) == len(pages)
    for p in pages:
        raw, home = (p.html or "").encode(), first[p.html or ""]
        again = len(raw) >= 100 and home != p.page_id
        assert tuple(got[p.page_id]) == (
            p.page_id,
            len(raw),
            hashlib.sha256(raw).hexdigest(),
            "revisit" if again else "response",
            home if again else None,
        )
