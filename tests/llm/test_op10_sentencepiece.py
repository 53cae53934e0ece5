"""Viterbi paths against the sentencepiece library, and round trips."""

from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
import sentencepiece
from sentencepiece import sentencepiece_model_pb2

from tickloom.llm import op10_sentencepiece as op
from tickloom.llm.words import WordTable, encoded

SMALL = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("piece_bpe_32k.model")
ODD = [
    "",
    " ",
    "a",
    "  two  spaces ",
    "x\n\ny \n z\r\n",
    "tab\there",
    "emoji 😀 中文 and Ünïcödé",
    "   \n    indented   code  =  1",
    "\x00\x01 \x7f",
    "a" * 3000,
    "HELLO WORLD... (test) [x]; don't",
    "日本語テキスト ​ ﻿",
]


def ours(texts, model, units):
    out, back = [], []
    for ids, count in op.encode_batch(encoded(texts), model, units):
        out += [x.tolist() for x in np.split(ids, np.cumsum(count)[:-1])]
        back += model.decode(ids, count)
    return out, back


def test_ids_equal_the_library(spark):
    texts = ODD + [r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").limit(60).collect()]
    library = sentencepiece.SentencePieceProcessor(model_file=PATH)
    model, units = op.pieces(PATH)
    got, back = ours(texts, model, units)
    assert got == library.encode(texts, num_threads=1)
    assert [b.decode() for b in back] == texts
    assert ours(texts, model, WordTable(model.encode_units, np.uint32, 3))[0] == got
    assert ours([None, "the ▁ mark"], model, units)[1] == [b"", b"the   mark"]


def test_runs_of_spaces_of_any_length_equal_the_library():
    library = sentencepiece.SentencePieceProcessor(model_file=PATH)
    model, units = op.pieces(PATH)
    assert model.run == 16
    ends = ["", "code", "\n", "中x", "😀", "ing  two", "\tq"]
    texts = [start + " " * n + end for start in ("", "a") for n in (*range(58, 100), 1000, 100_003) for end in ends]
    got, back = ours(texts, model, units)
    assert got == library.encode(texts, num_threads=1)
    assert [b.decode() for b in back] == texts


def test_unigram_paths_have_the_best_score(tmp_path):
    """The same pieces with scores of a unigram model: the library's own Viterbi is the measure."""
    model = sentencepiece_model_pb2.ModelProto()
    with open(PATH, "rb") as source:
        model.ParseFromString(source.read())
    model.trainer_spec.model_type = op.UNIGRAM
    for i, p in enumerate(model.pieces):
        if p.type == op.NORMAL:
            p.score = -2.0 - 12.0 * (i / 32_000) ** 0.5 - (i * 7919 % 1000) / 5000
    path = tmp_path / "unigram.model"
    path.write_bytes(model.SerializeToString())
    library = sentencepiece.SentencePieceProcessor(model_proto=model.SerializeToString())
    texts = ["The quick brown fox jumps over the lazy dog.", "internationalization of tokenizers", "ouen nterti thorreou", "naïve café"]
    pieces = op.Pieces(str(path))
    got, back = ours(texts, pieces, WordTable(pieces.encode_units, np.uint32))
    total = lambda ids: sum(pieces.scores[i] for i in ids)
    for mine, theirs in zip(got, library.encode(texts)):
        assert abs(total(mine) - total(theirs)) < 1e-3
    assert [b.decode() for b in back] == texts


def test_documents_with_nulls_and_clashing_names(spark):
    rows = [(1, "a b"), (1, "a b"), (None, "c"), (2, None), (3, "")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as ids", "2 as decoded")
    got = op.encode_documents(frame, "doc_id", "text", PATH).collect()
    assert sorted((str(r.doc_id), r.decoded, len(r.ids)) for r in got) == [("1", "a b", 2), ("1", "a b", 2), ("2", "", 0), ("3", "", 0), ("None", "c", 1)]
    assert op.encode_documents(frame.limit(0), "doc_id", "text", PATH).collect() == []


def test_query(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    got = {r.doc_id: r for r in op.op10_sentencepiece(spark, SMALL).collect()}
    library = sentencepiece.SentencePieceProcessor(model_file=PATH)
    assert got.keys() == docs.keys()
    for i, ids in zip(docs, library.encode(list(docs.values()), num_threads=1)):
        raw = docs[i].encode()
        assert tuple(got[i]) == (i, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), zlib.crc32(raw), True)
