"""Token ids in binary files of directly addressable codes."""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition

from tickloom.llm.common import table
from tickloom.llm.files import Written, commit, manifest, new_name, opened
from tickloom.llm.words import WordTable, encoded, scan, slices
from tickloom.session import scratch

END_ID = 1
CHUNK_BITS = 8
RANK_BITS = 512  # one entry of a rank directory for so many bits
SEGMENT_TOKENS = 1 << 21
_MAGIC = b"TLDAC001"


class Codes:
    """Directly addressable codes of unsigned 32-bit ids.

    Each id is cut into chunks of 8 bits, lowest first, and level k holds the k-th chunks of
    the ids that have so many. A bitmap on each level says which ids go on; the place of an
    id's next chunk is the number of set bits before its own, which a directory with the
    count before every 512 bits gives without decoding anything else.
    """

    def __init__(self, chunks: list[np.ndarray], bitmaps: list[np.ndarray], ranks: list[np.ndarray]):
        self.chunks, self.bitmaps, self.ranks = chunks, bitmaps, ranks

    def __len__(self) -> int:
        return len(self.chunks[0]) if self.chunks else 0

    @classmethod
    def of(cls, ids: np.ndarray) -> Codes:
        rest, chunks, bitmaps, ranks = ids.astype(np.uint32), [], [], []
        while len(rest):
            chunks.append((rest & 0xFF).astype(np.uint8))
            rest = rest >> CHUNK_BITS
            on = rest > 0
            bitmap = np.packbits(on, bitorder="little")
            bitmap = np.concatenate([bitmap, np.zeros(-len(bitmap) % (RANK_BITS // 8), np.uint8)])
            ones = np.bitwise_count(bitmap).reshape(-1, RANK_BITS // 8).sum(axis=1, dtype=np.uint32)
            bitmaps.append(bitmap)
            ranks.append((np.cumsum(ones) - ones).astype(np.uint32))
            rest = rest[on]
        return cls(chunks, bitmaps, ranks)

    def _rank(self, level: int, at: int) -> int:
        """Set bits of a level before a place."""
        block = at // RANK_BITS
        if block == len(self.ranks[level]):
            return len(self.chunks[level + 1]) if level + 1 < len(self.chunks) else 0
        first = block * (RANK_BITS // 8)
        whole, bits = divmod(at - block * RANK_BITS, 8)
        count = int(np.bitwise_count(self.bitmaps[level][first : first + whole]).sum())
        if bits:
            count += (int(self.bitmaps[level][first + whole]) & ((1 << bits) - 1)).bit_count()
        return int(self.ranks[level][block]) + count

    def token(self, at: int) -> int:
        """One id, from one chunk on each of its levels."""
        value = 0
        for level in range(len(self.chunks)):
            value |= int(self.chunks[level][at]) << (CHUNK_BITS * level)
            if not self.bitmaps[level][at >> 3] >> (at & 7) & 1:
                break
            at = self._rank(level, at)
        return value

    def tokens(self, begin: int, end: int) -> np.ndarray:
        """Consecutive ids; each level is read between the ranks of its ends only."""
        value = np.zeros(end - begin, np.uint32)
        alive = np.arange(end - begin)
        for level in range(len(self.chunks)):
            if begin == end:
                break
            value[alive] |= self.chunks[level][begin:end].astype(np.uint32) << np.uint32(CHUNK_BITS * level)
            bits = np.unpackbits(self.bitmaps[level][begin >> 3 : (end + 7) >> 3], bitorder="little")
            on = bits[begin & 7 : (begin & 7) + end - begin].view(bool)
            alive = alive[on]
            begin = self._rank(level, begin)
            end = begin + len(alive)
        return value

    def parts(self) -> Iterator[bytes]:
        yield struct.pack("<I", len(self.chunks))
        for chunk, bitmap, rank in zip(self.chunks, self.bitmaps, self.ranks, strict=True):
            yield struct.pack("<QQQ", len(chunk), len(bitmap), len(rank))
            yield from (chunk.tobytes(), bitmap.tobytes(), rank.astype("<u4").tobytes())

    @classmethod
    def parse(cls, data: memoryview, at: int) -> tuple[Codes, int]:
        (levels,) = struct.unpack_from("<I", data, at)
        at += 4
        chunks, bitmaps, ranks = [], [], []
        for _ in range(levels):
            n, m, k = struct.unpack_from("<QQQ", data, at)
            at += 24
            chunks.append(np.frombuffer(data, np.uint8, n, at))
            bitmaps.append(np.frombuffer(data, np.uint8, m, at + n))
            ranks.append(np.frombuffer(data, "<u4", k, at + n + m))
            at += n + m + 4 * k
        return cls(chunks, bitmaps, ranks), at


def segment(keys: list[int | None], lengths: np.ndarray, ids: np.ndarray) -> bytes:
    """Documents, with their keys and numbers of ids, and the codes of all their ids."""
    here = np.array([k is not None for k in keys], np.uint8)
    keys_of = np.array([k or 0 for k in keys], "<i8")
    body = b"".join(
        [struct.pack("<Q", len(keys)), here.tobytes(), keys_of.tobytes(), lengths.astype("<u8").tobytes(), *Codes.of(ids).parts()]
    )
    return struct.pack("<Q", len(body)) + body


def parse_segment(data: memoryview) -> tuple[list[int | None], np.ndarray, Codes]:
    (n,) = struct.unpack_from("<Q", data, 0)
    here = np.frombuffer(data, np.uint8, n, 8)
    keys = np.frombuffer(data, "<i8", n, 8 + n)
    lengths = np.frombuffer(data, "<u8", n, 8 + 9 * n).astype(np.int64)
    codes, _ = Codes.parse(data, 8 + 17 * n)
    return [k if ok else None for k, ok in zip(keys.tolist(), here.tolist())], lengths, codes


class TokenFileWriter(DataSourceArrowWriter):
    """Rows ``doc_id`` and ``ids`` (little-endian unsigned 32-bit), in the order they come."""

    def __init__(self, path: str):
        self.path = path

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        part, name = new_name(".dac")
        store, path = opened(self.path)
        store.create_dir(path, recursive=True)
        docs = tokens = held = 0
        keys: list[int | None] = []
        ids: list[np.ndarray] = []
        with store.open_output_stream(f"{path}/{name}", compression=None) as out:
            out.write(_MAGIC)

            def flush() -> None:
                lengths = np.array([len(x) for x in ids], np.int64)
                out.write(segment(keys, lengths, np.concatenate([np.zeros(0, "<u4"), *ids])))
                keys.clear()
                ids.clear()

            for batch in iterator:
                for key, raw in zip(batch.column("doc_id").to_pylist(), batch.column("ids")):
                    keys.append(key)
                    ids.append(np.frombuffer(raw.as_buffer(), "<u4"))
                    docs, tokens, held = docs + 1, tokens + len(ids[-1]), held + len(ids[-1])
                    if held >= SEGMENT_TOKENS:
                        flush()
                        held = 0
            flush()
        return Written(part, name, {"docs": docs, "tokens": tokens})

    def commit(self, messages) -> None:
        commit(self.path, messages)

    def abort(self, messages) -> None:
        """Files of a failed write are never named, so no reader sees them."""


class TokenFileReader(DataSourceReader):
    """One partition for each file. Only the wanted columns are made; ids are decoded if asked for."""

    def __init__(self, path: str, columns: list[str]):
        self.path, self.columns = path, columns

    def partitions(self) -> list[InputPartition]:
        found, start = [], 0
        for entry in manifest(self.path):
            found.append(InputPartition((entry["name"], start)))
            start += entry["tokens"]
        return found or [InputPartition(None)]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        if partition.value is None:
            return
        name, start = partition.value
        store, path = opened(self.path)
        with store.open_input_file(f"{path}/{name}") as source:
            if source.read(8) != _MAGIC:
                raise ValueError(f"{name} is not a token file")
            while head := source.read(8):
                keys, lengths, codes = parse_segment(memoryview(source.read(struct.unpack("<Q", head)[0])))
                ends = np.cumsum(lengths)
                made: dict[str, list] = {c: [] for c in self.columns}
                for i, (end, length) in enumerate(zip(ends.tolist(), lengths.tolist())):
                    row = {"doc_id": keys[i], "start": start + end - length, "n_tokens": length}
                    if "ids_crc32" in made or "ids" in made:
                        raw = codes.tokens(end - length, end).astype("<u4").tobytes()
                        row |= {"ids_crc32": zlib.crc32(raw), "ids": raw}
                    for c in self.columns:
                        made[c].append(row[c])
                start += int(lengths.sum())
                types = [pa.binary() if c == "ids" else pa.int64() for c in self.columns]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(made[c], t) for c, t in zip(self.columns, types)], names=self.columns
                )


class TokenFiles(DataSource):
    """``spark.read.format("tokenfiles")``; name the wanted columns with ``schema``."""

    @classmethod
    def name(cls) -> str:
        return "tokenfiles"

    def schema(self) -> str:
        return "doc_id long, start long, n_tokens long, ids_crc32 long, ids binary"

    def reader(self, schema) -> TokenFileReader:
        return TokenFileReader(self.options["path"], schema.fieldNames())

    def writer(self, schema, overwrite: bool) -> TokenFileWriter:
        return TokenFileWriter(self.options["path"])


class Vocabulary:
    """Ids of single words by the tokenizers library.

    The vocabulary splits at white space and drops it, lowers case, and never joins a letter
    or digit to punctuation that follows it, so a text's ids are its words' ids in turn and
    a word met before need not be encoded again. Words of letters only are encoded many at a
    time: each is then one pre-token, and the id that ends it is known by its word end.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        names = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(names.values()) + 1, bool)
        self.ends[[i for name, i in names.items() if name.endswith("</w>")]] = True

    def __call__(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        texts = [w.decode() for w in words]
        plain = np.array([t.isalpha() for t in texts], bool)
        found: list[np.ndarray | None] = [None] * len(texts)
        at = np.flatnonzero(plain)
        for begin in range(0, len(at), 5000):
            part = at[begin : begin + 5000]
            ids = np.array(self.tokenizer.encode(" ".join([texts[i] for i in part]), add_special_tokens=False).ids, np.uint32)
            stops = np.flatnonzero(self.ends[ids]) + 1
            if len(stops) != len(part):
                plain[part] = False  # a letter that falls apart when lowered
                continue
            for i, x in zip(part.tolist(), np.split(ids, stops[:-1])):
                found[i] = x
        at = np.flatnonzero(~plain)
        for i, x in zip(at.tolist(), self.tokenizer.encode_batch([texts[i] for i in at], add_special_tokens=False)):
            found[i] = np.array(x.ids, np.uint32)
        count = np.array([len(x) for x in found], np.int64)
        return np.concatenate([np.zeros(0, np.uint32), *found]), count


@lru_cache(maxsize=2)
def word_ids(path: str) -> WordTable:
    """The table of words met by this worker process."""
    return WordTable(Vocabulary(path), np.uint32)


def encode(frame: DataFrame, key: str, text: str, path: str, end_id: int) -> DataFrame:
    """``doc_id`` and ``ids`` (little-endian unsigned 32-bit) of whole texts, with the end id."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = word_ids(path)
        for batch in batches:
            texts = encoded(batch.column(1).to_pylist())
            for begin, end in slices(texts):
                ids, count = words.of(scan(texts[begin:end], lower=True, tails=True))
                stops = np.cumsum(count)
                whole = np.insert(ids, stops, end_id).astype("<u4").tobytes()
                ends = (4 * (stops + np.arange(1, len(count) + 1))).tolist()
                out = pa.array([whole[a:b] for a, b in zip([0, *ends[:-1]], ends)], pa.binary())
                keys = batch.column(0).slice(begin, end - begin)
                yield pa.RecordBatch.from_arrays([keys, out], names=["doc_id", "ids"])

    return frame.select(F.col(key).cast("long").alias("doc_id"), F.col(text)).mapInArrow(
        work, "doc_id long, ids binary"
    )


def in_key_order(frame: DataFrame, key: str, text: str) -> DataFrame:
    """Rows dealt to ranges of the key in ascending order (nulls first, ties by text)."""
    return frame.select(key, text).repartitionByRange(key).sortWithinPartitions(key, text)


def write_token_files(ids: DataFrame, path: str) -> None:
    """Writes ``doc_id`` and ``ids``, a file for each partition, and a manifest in their order."""
    ids.sparkSession.dataSource.register(TokenFiles)
    ids.write.format("tokenfiles").mode("append").save(path)


def read_token_files(spark: SparkSession, path: str, columns: str) -> DataFrame:
    spark.dataSource.register(TokenFiles)
    return spark.read.format("tokenfiles").schema(columns).load(path)


def op5_token_files(spark: SparkSession, sf_dir: str, vocabulary: str | None = None) -> DataFrame:
    """Ids of all documents, written to files and read back."""
    path = vocabulary or public_tokenizers.path("word_bpe_49k.json")
    ordered = in_key_order(table(spark, sf_dir, "documents"), "doc_id", "text")
    ids = encode(ordered, "doc_id", "text", path, END_ID)
    folder = scratch(spark, "op5-ids")
    write_token_files(ids, folder)
    return read_token_files(spark, folder, "doc_id long, start long, n_tokens long, ids_crc32 long")
