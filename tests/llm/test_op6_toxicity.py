"""Segments against brute force, and held-out accuracy."""

from __future__ import annotations

import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from tickloom.llm import op6_toxicity as op

SMALL, MEDIUM = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


def maximal(values):
    """All maximal scoring segments by definition: the best segment, then left and right of it."""
    best = None
    for i in range(len(values)):
        for j in range(i + 1, len(values) + 1):
            key = (sum(values[i:j]), -(j - i))
            if best is None or key > best[0]:
                best = (key, i, j)
    if best is None or best[0][0] <= 0:
        return []
    (total, _), i, j = best
    return [
        *maximal(values[:i]),
        (i, j, total),
        *[(j + a, j + b, s) for a, b, s in maximal(values[j:])],
    ]


def test_all_maximal_segments_are_found():
    for seed in range(60):
        rng = random.Random(seed)
        texts = [[rng.choice([-3, -2, -1, 1, 2.5, 4.25]) + rng.random() / 100 for _ in range(rng.randint(0, 14))] for _ in range(4)]
        flat = np.array([x for t in texts for x in t], float)
        offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
        got = op.passages(flat, offsets)
        for t, found in zip(texts, got):
            want = maximal(t)
            assert [(a, b) for a, b, _ in found] == [(a, b) for a, b, _ in want]
            assert np.allclose([s for _, _, s in found], [s for _, _, s in want])


def test_a_very_long_text_takes_linear_time():
    """Runs that fall for long, then rise over all of them, then fall again."""
    n = 200_000
    falling = np.tile([1.0, -1.5], n)
    (found,) = op.passages(falling, np.array([0, len(falling)]))
    assert len(found) == n
    rising = np.tile([1.5, -1.0], n)
    both = np.concatenate([falling, rising, falling])
    (found,) = op.passages(both, np.array([0, len(both)]))
    assert len(found) == 2 * n + 1  # the rising runs are one segment
    assert max(found, key=lambda s: s[2])[:2] == (2 * n, 4 * n - 1)


def fixture(spark):
    rng = random.Random(1)
    words = [f"w{i}" for i in range(300)]
    docs, labels = [], []
    for i in range(400):
        text = [rng.choice(words) for _ in range(rng.randint(20, 200))]
        toxic = i % 4 == 0
        if toxic:
            at = rng.randrange(len(text))
            text[at:at] = rng.sample(["Vile", "nasty,", "awful.", "rotten", "foul"], 4)
        docs.append((i, " ".join(text), "x"))
        labels.append((i, 1 if toxic else 0))
    docs += [(1000, None, "x"), (1001, "", "x"), (None, "vile nasty awful rotten", "x"), (0, docs[0][1], "x")]
    labels += [(1001, None), (None, 1), (5, 5)]
    return (
        spark.createDataFrame(docs, "doc_id long, text string, score string"),
        spark.createDataFrame(labels, "doc_id long, toxic int"),
    )


def test_planted_passages_nulls_and_repeats(spark):
    docs, labels = fixture(spark)
    model = op.fit(docs, labels)
    got = docs.withColumn("p", op.score(F.col("text"), model, spark)).collect()
    for r in got:
        assert 0 <= r.p <= 1
        if r.doc_id is not None and r.doc_id < 400:
            assert (r.p >= 0.5) == (r.doc_id % 4 == 0)
        elif r.doc_id is not None:
            assert r.p < 0.5
    found = op.toxic_passages(docs.filter("doc_id < 400"), model, "doc_id", "text").collect()
    assert {r.doc_id for r in found} >= set(range(0, 400, 4))
    text = {r.doc_id: r.text.split() for r in got if r.doc_id is not None and r.doc_id < 400}
    best = max(found, key=lambda r: r.evidence)
    assert {"vile", "nasty,", "awful.", "rotten", "foul"} & {w.lower() for w in text[best.doc_id]}
    again = " ".join(["vile"] * 500)
    one = spark.createDataFrame([("vile",), (again,)], "text string").select(op.score(F.col("text"), model, spark)).collect()
    assert one[1][0] < 0.999


def test_no_labels_and_empty(spark):
    docs, labels = fixture(spark)
    model = op.fit(docs, labels.filter("toxic = 0"))
    assert docs.limit(5).select(op.score(F.col("text"), model, spark).alias("p")).filter("p >= 0.5").count() == 0
    assert docs.limit(0).select(op.score(F.col("text"), model, spark)).collect() == []


def test_held_out_fold_is_never_read(spark):
    docs, labels = fixture(spark)
    out = (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5) == 0
    flipped = labels.withColumn("toxic", F.when(out, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = op.fit(docs, labels), op.fit(docs, flipped)
    assert np.array_equal(a.scores, b.scores) and (a.slope, a.offset) == (b.slope, b.offset)


def test_query(spark):
    got = {r.doc_id: r for r in op.op6_toxicity(spark, MEDIUM).collect()}
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in got.items())
    assert all(r.predicted == int(r.score >= 0.5) for r in got.values())
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{MEDIUM}/labels.parquet").collect()}
    judged = [(got[i].predicted, y) for i, y in labels.items() if got[i].held_out]
    assert np.mean([p == y for p, y in judged]) > 0.93
    assert sum(p for p, y in judged if y) >= 0.6 * sum(y for _, y in judged)
