"""WARC archives as a Spark data source."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualTo,
    Filter,
    In,
    InputPartition,
)

from tickloom.llm.common import table
from tickloom.llm.files import MANIFEST, Written, commit, manifest, new_name, opened
from tickloom.session import scratch

LEAST_REVISIT = 100  # bytes of a payload that a revisit may stand for
LEVEL = 3
BATCH_BYTES = 8 << 20
_HEAD = 1 << 12
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

# Fixed values of the format: names of header fields by column.
FIELDS = {
    "record_type": "WARC-Type",
    "record_id": "WARC-Record-ID",
    "target_uri": "WARC-Target-URI",
    "date": "WARC-Date",
    "refers_to_id": "WARC-Refers-To",
    "payload_digest": "WARC-Payload-Digest",
    "payload_length": "X-Payload-Length",
    "content_length": "Content-Length",
}
NUMBERS = {"payload_length", "content_length"}
SCHEMA = "record_type string, record_id string, target_uri string, date string, refers_to_id string, payload_digest string, payload_length long, content_length long, payload binary"


def member(head: bytes, block: bytes) -> bytes:
    """One record as a gzip member whose extra field ``sl`` tells its compressed and full size."""
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, -15)
    data = head + block + b"\r\n\r\n"
    body = packer.compress(data) + packer.flush()
    full = len(data)
    whole = 10 + 2 + 12 + len(body) + 8
    extra = b"sl" + (8).to_bytes(2, "little") + whole.to_bytes(4, "little") + (full & 0xFFFFFFFF).to_bytes(4, "little")
    return (
        b"\x1f\x8b\x08\x04\x00\x00\x00\x00\x00\x03"
        + len(extra).to_bytes(2, "little")
        + extra
        + body
        + zlib.crc32(data).to_bytes(4, "little")
        + (full & 0xFFFFFFFF).to_bytes(4, "little")
    )


def header(fields: dict[str, str | int | None]) -> bytes:
    """A record's header; line ends in values would break it and become spaces."""
    lines = ["WARC/1.1"]
    for name, value in fields.items():
        if value is not None:
            lines.append(f"{name}: {re.sub(r'[\r\n]+', ' ', str(value))}")
    return ("\r\n".join(lines) + "\r\n\r\n").encode()


def record(row: dict) -> bytes:
    """A response with its payload, or a revisit with its HTTP header only."""
    payload = row["payload"] if row["record_type"] == "response" else b""
    block = _HTTP % row["payload_length"] + payload
    fields = {name: row.get(column) for column, name in FIELDS.items() if column != "content_length"}
    if row["record_type"] == "revisit":
        fields["WARC-Profile"] = _PROFILE
    fields["Content-Type"] = "application/http; msgtype=response"
    fields["Content-Length"] = len(block)
    return member(header(fields), block)


def parse_header(data: bytes) -> dict[str, str]:
    """Header fields by lower-case name; a line that begins with white space goes on with the one before."""
    found: dict[str, str] = {}
    name = ""
    for line in data.decode("utf-8", "replace").split("\r\n")[1:]:
        if line[:1] in (" ", "\t") and name:
            found[name] += " " + line.strip()
        elif ":" in line:
            name, _, value = line.partition(":")
            name = name.strip().lower()
            found[name] = value.strip()
    return found


class Stream:
    """Reads a file in large pieces, and goes past bytes that nobody wants."""

    def __init__(self, source, piece: int = 1 << 20):
        self.source, self.piece, self.data = source, piece, b""

    def peek(self, n: int) -> bytes:
        while len(self.data) < n:
            more = self.source.read(max(self.piece, n - len(self.data)))
            if not more:
                break
            self.data += more
        return self.data[:n]

    def skip(self, n: int) -> None:
        if n <= len(self.data):
            self.data = self.data[n:]
            return
        self.source.seek(self.source.tell() + n - len(self.data))
        self.data = b""


def sizes(start: bytes) -> int | None:
    """The compressed size that a gzip member's extra field tells, if any."""
    if len(start) < 12 or not start[3] & 4:
        return None
    extra = start[12 : 12 + int.from_bytes(start[10:12], "little")]
    at = 0
    while at + 4 <= len(extra):
        n = int.from_bytes(extra[at + 2 : at + 4], "little")
        if extra[at : at + 2] == b"sl" and n == 8:
            return int.from_bytes(extra[at + 4 : at + 8], "little")
        at += 4 + n
    return None


def _packed_records(stream: Stream, wanted) -> Iterator[tuple[dict[str, str], bytes | None]]:
    while len(start := stream.peek(_HEAD)) > 2:
        if start[:2] != b"\x1f\x8b":
            raise ValueError("not a gzip member")
        whole = sizes(start)
        data = start if whole is None else stream.peek(min(whole, _HEAD))
        inflate = zlib.decompressobj(31)
        text, used = inflate.decompress(data), len(data)
        while b"\r\n\r\n" not in text and not inflate.eof:
            data = stream.peek(used + _HEAD)[used:]
            if not data:
                raise ValueError("a record ends early")
            used += len(data)
            text += inflate.decompress(data)
        end = text.index(b"\r\n\r\n") + 4
        fields = parse_header(text[:end])
        keep, decode = wanted(fields)
        body = None
        if (keep and decode) or whole is None:
            parts = [text[end:]]
            while not inflate.eof:
                data = stream.peek(used + (1 << 16))[used:]
                if not data:
                    raise ValueError("a record ends early")
                used += len(data)
                parts.append(inflate.decompress(data))
            used -= len(inflate.unused_data)
            if keep and decode:
                body = b"".join(parts)[: int(fields.get("content-length", 0))]
        stream.skip(used if whole is None else whole)
        if keep:
            yield fields, body


def _plain_records(stream: Stream, wanted) -> Iterator[tuple[dict[str, str], bytes | None]]:
    while True:
        n = _HEAD
        while b"\r\n\r\n" not in (text := stream.peek(n)) and len(text) == n:
            n *= 2
        if not text.strip():
            return
        lead = len(text) - len(text.lstrip(b"\r\n"))
        end = text.index(b"\r\n\r\n", lead) + 4
        fields = parse_header(text[lead:end])
        length = int(fields.get("content-length", 0))
        keep, decode = wanted(fields)
        stream.skip(end)
        body = stream.peek(length) if keep and decode else None
        stream.skip(length)
        if keep:
            yield fields, body


def records(source, packed: bool, wanted) -> Iterator[tuple[dict[str, str], bytes | None]]:
    """Headers and blocks of an archive's records, in order.

    ``wanted`` sees a record's header and says whether to give the record and whether to
    decode its block. Blocks that are not decoded are passed over: by the size in the gzip
    extra field, by Content-Length in a file that is not packed, or else by inflating.
    """
    stream = Stream(source)
    yield from _packed_records(stream, wanted) if packed else _plain_records(stream, wanted)


def payload_of(fields: dict[str, str], block: bytes) -> bytes:
    """The block of a record without its HTTP header, if it has one."""
    if fields.get("content-type", "").startswith("application/http"):
        return block.partition(b"\r\n\r\n")[2]
    return block


@dataclass
class ArchiveFile(InputPartition):
    path: str
    packed: bool

    def __init__(self, path: str, packed: bool):
        super().__init__((path, packed))
        self.path, self.packed = path, packed


@dataclass
class WarcReader(DataSourceReader):
    """One partition for each archive. Filters on header columns are settled before a payload is read."""

    path: str
    columns: list[str]
    tests: list[tuple[str, list]] = field(default_factory=list)

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for f in filters:
            column = ".".join(f.attribute) if isinstance(f, (EqualTo, In)) else ""
            if column in FIELDS and isinstance(f, (EqualTo, In)):
                self.tests.append((column, [f.value] if isinstance(f, EqualTo) else list(f.value)))
            else:
                yield f

    def partitions(self) -> list[InputPartition]:
        store, path = opened(self.path)
        if store.get_file_info(f"{path}/{MANIFEST}").type == fs.FileType.File:
            names = [f"{path}/{entry['name']}" for entry in manifest(self.path)]
        else:
            found = store.get_file_info(fs.FileSelector(path, recursive=True))
            names = sorted(f.path for f in found if f.is_file and re.search(r"\.warc(\.gz)?$", f.path))
        return [ArchiveFile(n, n.endswith(".gz")) for n in names] or [ArchiveFile("", False)]

    def value(self, fields: dict[str, str], column: str):
        found = fields.get(FIELDS[column].lower())
        return int(found) if found is not None and column in NUMBERS else found

    def read(self, partition: ArchiveFile) -> Iterator[pa.RecordBatch]:
        if not partition.path:
            return
        decode = "payload" in self.columns
        store, _ = opened(self.path)

        def wanted(fields: dict[str, str]) -> tuple[bool, bool]:
            return all(self.value(fields, c) in values for c, values in self.tests), decode

        made: dict[str, list] = {c: [] for c in self.columns}
        held = 0

        def batch() -> pa.RecordBatch:
            types = [pa.binary() if c == "payload" else pa.int64() if c in NUMBERS else pa.string() for c in made]
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(made.values(), types)], names=list(made))

        with store.open_input_file(partition.path) as source:
            for fields, block in records(source, partition.packed, wanted):
                for c in made:
                    made[c].append(payload_of(fields, block) if c == "payload" else self.value(fields, c))
                held += 1000 + len(block or b"")
                if held >= BATCH_BYTES:
                    yield batch()
                    made, held = {c: [] for c in self.columns}, 0
        if held:
            yield batch()


class WarcWriter(DataSourceArrowWriter):
    """One archive for each task; the columns are those of the source, of which ``payload`` may be null."""

    def __init__(self, path: str):
        self.path = path

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        part, name = new_name(".warc.gz")
        store, path = opened(self.path)
        store.create_dir(path, recursive=True)
        count = 0
        with store.open_output_stream(f"{path}/{name}", compression=None) as out:
            for batch in iterator:
                columns = [c for c in batch.schema.names if c in FIELDS or c == "payload"]
                for i in range(batch.num_rows):
                    out.write(record({c: batch.column(c)[i].as_py() for c in columns}))
                    count += 1
        return Written(part, name, {"records": count})

    def commit(self, messages) -> None:
        commit(self.path, messages)

    def abort(self, messages) -> None:
        """Files of a failed write are never named, so no reader sees them."""


class Warc(DataSource):
    """``spark.read.format("warc")`` over a folder of ``.warc`` and ``.warc.gz`` files.

    Name the wanted columns with ``schema``: without ``payload`` no block is decoded. Equality
    and IN filters on header columns reach the source if spark.sql.python.filterPushdown.enabled
    is set.
    """

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader(self.options["path"], schema.fieldNames())

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        return WarcWriter(self.options["path"])


def page_records(pages: DataFrame, key: str, url: str, html: str) -> DataFrame:
    """Pages as records: of equal payloads of LEAST_REVISIT bytes or more, the one of the smallest
    key is a response and the others revisit it; all others are responses.

    A null page is an empty payload. Rows with the same key and payload are all responses. A
    null key comes after all others and is written as an empty id.
    """
    payload = F.encode(F.coalesce(F.col(html), F.lit("")), "utf-8")
    rows = pages.select(
        F.col(key).cast("long").alias("_key"), F.col(url).alias("target_uri"), payload.alias("payload")
    ).withColumns({"_digest": F.sha2("payload", 256), "payload_length": F.octet_length("payload").cast("long")})
    long = F.col("payload_length") >= LEAST_REVISIT
    # only digests that occur more than once matter; payloads are not shuffled for this
    slim = rows.filter(long).select("_digest", "_key").groupBy("_digest")
    first = slim.agg(F.min("_key").alias("_first"), F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    marked = rows.join(first.drop("_n").withColumnRenamed("_digest", "_d"), F.col("_digest") == F.col("_d"), "left")
    revisit = F.col("_first").isNotNull() & ~F.col("_key").eqNullSafe(F.col("_first"))
    ident = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("")), F.lit(">"))
    return marked.select(
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        ident(F.col("_key")).alias("record_id"),
        "target_uri",
        F.when(revisit, ident(F.col("_first"))).alias("refers_to_id"),
        F.concat(F.lit("sha256:"), F.col("_digest")).alias("payload_digest"),
        "payload_length",
        F.when(~revisit, F.col("payload")).alias("payload"),
    )


def write_archives(rows: DataFrame, path: str) -> None:
    rows.sparkSession.dataSource.register(Warc)
    rows.write.format("warc").mode("append").save(path)


def read_archives(spark: SparkSession, path: str, columns: str) -> DataFrame:
    """Records of a folder; turns on the passing of filters to sources for this session."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(Warc)
    return spark.read.format("warc").schema(columns).load(path)


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages, written to archives and read back.

    Length and digest of a response are taken from its payload as read; those of a revisit,
    which has no payload, from its header, and its block is not decoded.
    """
    folder = scratch(spark, "op4-warc")
    write_archives(page_records(table(spark, sf_dir, "pages"), "page_id", "url", "html"), folder)
    page = lambda c: F.regexp_extract(c, r"<urn:page:(-?\d+)>", 1).try_cast("long")
    kinds = {
        "response": ("payload binary", F.octet_length("payload").cast("long"), F.sha2("payload", 256)),
        "revisit": (
            "payload_length long, payload_digest string",
            F.col("payload_length"),
            F.substring_index("payload_digest", ":", -1),
        ),
    }
    parts = []
    for kind, (columns, size, digest) in kinds.items():
        read = read_archives(spark, folder, f"record_type string, record_id string, refers_to_id string, {columns}")
        parts.append(
            read.filter(F.col("record_type") == kind).select(
                page("record_id").alias("page_id"),
                size.alias("payload_bytes"),
                digest.alias("payload_digest"),
                "record_type",
                page("refers_to_id").alias("refers_to"),
            )
        )
    return parts[0].unionByName(parts[1])
