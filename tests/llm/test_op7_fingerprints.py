"""Fingerprints against a plain version of their parts."""

from __future__ import annotations

import hashlib
import math
import random
from collections import Counter

import numpy as np
import pytest

from tickloom.llm import op7_fingerprints as op

SMALL = "/root/testdata/sf0.001"


def test_entropies():
    data = np.frombuffer(bytes(random.Random(2).choices(b"abcdefgh  ", k=500)) + b"a" * 100, np.uint8)
    got = op.entropies(data)
    for i in range(len(got)):
        counts = Counter(data[i : i + op.WINDOW].tolist()).values()
        want = -sum(c / op.WINDOW * math.log2(c / op.WINDOW) for c in counts)
        assert got[i] == pytest.approx(want, abs=1e-3)


def test_features_do_not_depend_on_neighbours():
    rng = random.Random(4)
    texts = [bytes(rng.choices(b"etaoin shrdlu", k=n)) for n in (0, 10, 63, 64, 127, 500, 3000)]
    alone = [op.digests([t])[0][0] for t in texts]
    assert [d[0] for d in op.digests(texts)] == alone
    start, _ = op.features(np.frombuffer(texts[-1], np.uint8), np.full(3000, 3000))
    rank = op.ranks(op.entropies(np.frombuffer(texts[-1], np.uint8)))
    wins = Counter(min(range(i, i + op.WINDOW), key=lambda j: (rank[j], j)) for i in range(len(rank) - op.WINDOW + 1))
    assert start.tolist() == sorted(j for j, n in wins.items() if n >= op.POPULAR)


@pytest.mark.parametrize("window, popular", [(op.WINDOW, op.POPULAR), (op.SHORT_WINDOW, op.SHORT_POPULAR)])
def test_features_are_the_winners_of_races(window, popular):
    rng = random.Random(window)
    for size in (2 * window + popular - 3, 2 * window + popular - 2, 141, 142, 700):
        text = bytes(rng.choices(b"etaoin shrdlu  ", k=size))
        values = np.array(
            [-sum(c / window * math.log2(c / window) for c in Counter(text[i : i + window]).values()) for i in range(size - window + 1)]
        )
        rank = op.ranks(np.round(values, 6), window)
        wins = Counter(min(range(i, i + window), key=lambda j: (rank[j], j)) for i in range(len(rank) - window + 1))
        start, _ = op.features(np.frombuffer(text, np.uint8), np.full(size, size), window, popular)
        assert start.tolist() == sorted(j for j, n in wins.items() if n >= popular and rank[j] < 1 << 16)


def test_short_texts_resemble_their_edits():
    rng = random.Random(3)
    words = "some texts are short but nobody wants to lose their likeness only for that small reason alone".split()
    near, far = [], []
    for size in range(30, op.SHORT, 3):
        a, b = (" ".join(rng.choices(words, k=60)).title()[:size] for _ in range(2))
        c = "".join(rng.choices("zxqjkvw \u00e4", k=size))[: size // 2]
        x, y, z = op.digests([a.encode(), op.edited(a, b).encode(), c.encode()])
        near.append(op.likeness(x, y))
        far.append(op.likeness(x, z))
        assert op.likeness(x, x) == 1
    assert min(near) > 0.1 and np.mean(near) > 0.4 and np.mean(far) < 0.05
    # the features of a text do not depend on others it is worked on with, of either kind
    texts = [bytes(rng.choices(b"etaoin shrdlu", k=n)) for n in (0, 15, 16, 141, 142, 900, 60)]
    assert [d[0] for d in op.digests(texts)] == [op.digests([t])[0][0] for t in texts]


def test_likeness():
    rng = random.Random(7)
    a = bytes(rng.choices(b"etaoin shrdlu,.", k=40_000))
    b = a[:30_000] + bytes(rng.choices(b"etaoin shrdlu,.", k=10_000))
    c = bytes(rng.choices(b"etaoin shrdlu,.", k=40_000))
    x, y, z = op.digests([a, b, c])
    assert op.likeness(x, x) == 1 and op.likeness(x, y) == op.likeness(y, x) > 0.5 > 0.1 > op.likeness(x, z)
    assert op.likeness(op.digests([b"short"])[0], x) == 0


@pytest.mark.parametrize("block_bytes", [50, 1 << 20])
def test_order_nulls_ties_and_blocks(spark, block_bytes):
    rows = [(i * 3, "".join(random.Random(i).choices("aäo ß€x", k=40 + i))) for i in range(40)]
    rows += [(None, "null key"), (9, None), (9, "tie"), (9, "tie"), (12, "")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as block", "'x' as n_chars").repartition(4)
    got = op.fingerprint_documents(frame, "doc_id", "text", block_bytes).collect()
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] or ""))
    want = []
    for k, (i, text) in enumerate(order):
        t, after = text or "", order[(k + 1) % len(order)][1] or ""
        want.append((i, len(t), hashlib.sha256(op.edited(t, after).encode()).hexdigest()))
    key = lambda r: (str(r[0]), r[2])
    assert sorted([(r.doc_id, r.n_chars, r.edited_sha256) for r in got], key=key) == sorted(want, key=key)


def test_one_document_and_none(spark):
    frame = spark.createDataFrame([(1, "abcdef")], "doc_id long, text string")
    (row,) = op.fingerprint_documents(frame, "doc_id", "text").collect()
    assert row.edited_sha256 == hashlib.sha256(b"abcdab").hexdigest() and row.near_next == 1
    assert op.fingerprint_documents(frame.limit(0), "doc_id", "text").collect() == []


def test_query(spark):
    docs = sorted(((r.doc_id, r.text or "") for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()), reverse=True)
    got = {r.doc_id: r for r in op.op7_fingerprints(spark, SMALL).collect()}
    for k, (i, text) in enumerate(docs):
        j, after = docs[(k + 1) % len(docs)]
        changed = op.edited(text, after)
        one, new, other = (op.digests([t.encode()])[0] for t in (text, changed, after))
        assert tuple(got[i]) == (
            i,
            len(text),
            hashlib.sha256(changed.encode()).hexdigest(),
            one[0],
            new[0],
            pytest.approx(op.likeness(one, new)),
            pytest.approx(op.likeness(one, other)),
        )
    assert np.mean([r.near_edited for r in got.values()]) > 0.4 > 0.05 > np.mean([r.near_next for r in got.values()])
