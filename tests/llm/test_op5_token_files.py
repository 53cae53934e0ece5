"""Codes against plain arrays, and files against the tokenizers library."""

from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tickloom.llm.op5_token_files import (
    Codes,
    encode,
    in_key_order,
    op5_token_files,
    read_token_files,
    word_ids,
    write_token_files,
)
from tickloom.llm.words import WordTable, encoded, scan, slices
from tickloom.session import scratch

SMALL = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    "",
    " \t\r\n\x0b\x0c ",
    "Don't STOP, it's 'quoted'... (x). [y]; z:9,000.50% #tag & co* $5",
    "foo<|endoftext|>bar. <|startoftext|>, été İstanbul Kelvin ΟΔΟΣ. ß",
    "日本語 текст nbsp em​zw 😀😀!!! ...",
    "a" * 5000 + " " + ",." * 400,
    "\x00 \x1f ﻿bom",
]


@pytest.mark.parametrize("most", [1, 255, 256, 70_000, 1 << 24, (1 << 32) - 1])
def test_codes(most):
    rng = np.random.default_rng(most)
    ids = (rng.random(3000) ** 4 * most).astype(np.uint32)
    ids[-1] = most
    body = memoryview(b"".join(Codes.of(ids).parts()))
    codes, end = Codes.parse(body, 0)
    assert end == len(body) and len(codes) == 3000
    assert [codes.token(i) for i in range(0, 3000, 7)] == ids[::7].tolist()
    for a, b in ((0, 3000), (0, 0), (511, 513), (512, 1024), (1000, 1001), (2999, 3000)):
        assert codes.tokens(a, b).tolist() == ids[a:b].tolist()
    assert len(Codes.of(np.zeros(0, np.uint32))) == 0


def test_words_are_encoded_as_in_whole_texts():
    library = Tokenizer.from_file(PATH)
    texts = encoded([*ODD, None, 3])
    assert texts[-2:] == [b"", b""]
    words = word_ids(PATH)
    for most in (words.most, 5):
        small = WordTable(words.compute, np.uint32, most)
        for _ in range(2):
            got = []
            for a, b in slices(texts):
                ids, count = small.of(scan(texts[a:b], lower=True, tails=True))
                got += [x.tolist() for x in np.split(ids, np.cumsum(count)[:-1])]
            assert got[: len(ODD)] == [e.ids for e in library.encode_batch(ODD, add_special_tokens=False)]


def test_files_with_nulls_ties_and_empty(spark):
    rows = [(5, "b c"), (None, "x"), (5, "a"), (-3, None), (7, ""), (None, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    folder = scratch(spark, "t")
    write_token_files(encode(in_key_order(frame, "doc_id", "text"), "doc_id", "text", PATH, 1), folder)
    got = sorted(read_token_files(spark, folder, "doc_id long, start long, n_tokens long, ids binary").collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == [None, None, -3, 5, 5, 7]
    assert [r.n_tokens for r in got] == [1, 2, 1, 2, 3, 1]
    assert [r.start for r in got] == [0, 1, 3, 4, 6, 9]
    assert all(np.frombuffer(r.ids, "<u4")[-1] == 1 for r in got)
    empty = scratch(spark, "t")
    write_token_files(encode(frame.limit(0), "doc_id", "text", PATH, 1), empty)
    assert read_token_files(spark, empty, "doc_id long").collect() == []


def test_query(spark):
    docs = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect())
    got = {r.doc_id: tuple(r)[1:] for r in op5_token_files(spark, SMALL).collect()}
    start = 0
    library = Tokenizer.from_file(PATH)
    for (i, _), e in zip(docs, library.encode_batch([t or "" for _, t in docs], add_special_tokens=False)):
        ids = np.array([*e.ids, 1], "<u4")
        assert got[i] == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert len(got) == len(docs)
