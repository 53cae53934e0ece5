"""Knapsack and patterns against enumeration and bounds; sequences put together again."""

from __future__ import annotations

import itertools
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tickloom.llm import op13_packing as m

SMALL = "/root/testdata/sf0.001"
VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def enumerated(worth, most, room):
    best = 0.0
    for counts in itertools.product(*[range(int(min(a, room // (i + 1))) + 1) for i, a in enumerate(most)]):
        if sum(c * (i + 1) for i, c in enumerate(counts)) <= room:
            best = max(best, sum(c * w for c, w in zip(counts, worth)))
    return best


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 20), st.integers(0, 3)), min_size=1, max_size=5))
def test_knapsack_is_the_best_of_all(rows):
    worth, most = np.array([w for w, _ in rows], float), np.array([a for _, a in rows])
    room = np.arange(1, len(rows) + 1)
    for limit in (None, most):
        value, counts = m.knapsack(worth, limit)
        bound = np.full(len(rows), len(rows)) if limit is None else most
        assert value == pytest.approx(enumerated(worth, bound, len(rows)))
        assert counts @ worth == pytest.approx(value) and counts @ room <= len(rows) and (counts <= bound).all()


@settings(max_examples=15, deadline=None)
@given(st.integers(0, 10**6), st.integers(1, 3000), st.sampled_from([16, 64, 256]))
def test_patterns_hold_the_demand_in_nearly_the_fewest_sequences(seed, n, units):
    rng = np.random.default_rng(seed)
    demand = np.bincount(rng.integers(0, rng.integers(1, units + 1), n), minlength=units)
    made = m.patterns(demand)
    assert (sum(p.counts * p.copies for p in made) == demand).all()
    assert all(0 < p.units() <= units and p.copies > 0 for p in made)
    program = sum(times for _, times in m.generated(demand))
    assert sum(p.copies for p in made) <= program + 0.25 * np.count_nonzero(demand) + 2
    fewest = demand @ np.arange(1, units + 1) / units
    assert program >= fewest - 1e-6


def test_program_against_known_optima():
    demand = np.zeros(10, np.int64)
    demand[[5, 4, 2]] = [10, 10, 20]  # 6, 5 and 3 units: 5+5 five times, 6+3 ten times, 3+3+3 for the rest
    assert sum(t for _, t in m.generated(demand)) == pytest.approx(5 + 10 + 10 / 3)
    assert m.generated(np.zeros(10, np.int64)) == [] and m.patterns(np.zeros(10, np.int64)) == []


def packed(spark, sizes):
    rows = spark.createDataFrame([(i, n) for i, n in enumerate(sizes)], "row long, n_tokens long")
    return [(r.row, r.start, r.length, r.sequence_id, r.offset) for r in m.packed(rows).collect()]


def checked(pieces, sizes):
    """Every token lies in one piece, sequences have no gaps; the tokens of padding."""
    of_row, of_sequence = defaultdict(list), defaultdict(list)
    for row, start, length, sequence, offset in pieces:
        of_row[row].append((start, length))
        of_sequence[sequence].append((offset, length))
    for row, size in enumerate(sizes):
        at = 0
        for start, length in sorted(of_row[row]):
            assert start == at and length > 0
            at += length
        assert at == size
    padding = 0
    for parts in of_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 4096
        padding += 0 if at & (at - 1) == 0 else 4096 - at
    return padding


@pytest.mark.parametrize(
    "sizes",
    [
        [1],
        [4096],
        [4095, 1, 8192],
        [100_001, 3],
        [2049] * 300,
        [17] * 5000,
        [int(x) for x in np.random.default_rng(3).lognormal(6, 1.2, 3000) + 1],
    ],
    ids=["one", "full", "edges", "very long", "halves", "repeats", "mixed"],
)
def test_sequences_are_whole_and_padded_little(spark, sizes):
    pieces = packed(spark, sizes)
    assert checked(pieces, sizes) <= 0.002 * sum(sizes)
    whole = {(row, start) for row, start, length, *_ in pieces if length == sizes[row] - start}
    if len(sizes) == 3000:  # nearly all documents are cut nowhere but at whole sequences
        assert len({row for row, start in whole if start % 4096 == 0}) > 0.95 * len(sizes)


def test_no_documents(spark):
    assert packed(spark, []) == []


def test_documents_with_nulls_repeats_and_clashing_names(spark):
    rows = [(None, None), (1, ""), (2, "Some words, of a text."), (2, "Some words, of a text."), (3, "long text " * 60_000)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    frame = frame.withColumns({c: frame["text"] for c in ("row", "ids", "start", "length", "rank", "n_tokens")})
    got = m.pack_documents(frame, "doc_id", "text", VOCABULARY).collect()
    tokenizer = Tokenizer.from_file(VOCABULARY)
    want = sorted(
        ((k is not None, k or 0), [*tokenizer.encode(t or "", add_special_tokens=False).ids, 2]) for k, t in rows
    )
    pieces = defaultdict(list)
    for r in got:
        pieces[r.row].append((r.start, r))
    made = []
    for parts in pieces.values():
        found = [r for _, r in sorted(parts, key=lambda p: p[0])]
        ids = np.frombuffer(b"".join(r.ids for r in found), "<u4").tolist()
        assert all(r.doc_tokens == len(ids) and len(r.ids) == 4 * r.length for r in found)
        made.append(((found[0].doc_id is not None, found[0].doc_id or 0), ids))
    assert sorted(made) == want


def test_query(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    tokenizer = Tokenizer.from_file(VOCABULARY)
    ids = {d.doc_id: [*tokenizer.encode(d.text or "", add_special_tokens=False).ids, 2] for d in docs}
    got = m.op13_packing(spark, SMALL)
    assert got.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    rows = got.collect()
    for r in rows:
        assert r.doc_tokens == len(ids[r.doc_id])
        piece = np.array(ids[r.doc_id][r.start : r.start + r.length], "<u4")
        assert r.ids_crc32 == zlib.crc32(piece.tobytes())
    number = {key: i for i, key in enumerate(ids)}
    padding = checked([(number[r.doc_id], r.start, r.length, r.sequence_id, r.offset) for r in rows], [len(x) for x in ids.values()])
    assert padding <= 0.002 * sum(map(len, ids.values()))
