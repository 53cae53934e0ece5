"""Components of near-equal texts against all pairs."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest

from tickloom.llm import common
from tickloom.llm import components as parts
from tickloom.llm import op8_near_dedup as op
from tickloom.llm.components import components
from tickloom.session import written

SMALL = "/root/testdata/sf0.001"
LOWER = {c: c + 32 for c in range(65, 91)}


def shingles(text, size):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if not words:
        return frozenset()
    if len(words) < size:
        return frozenset([tuple(words)])
    return frozenset(zip(*[words[k:] for k in range(size)]))


def brute(rows, size):
    """Rows with their number of shingles and component, from all pairs of distinct sets."""
    sets = {}
    for i, t in rows:
        if i is not None:
            sets.setdefault(shingles(t, size), set()).add(i)
    sets.pop(frozenset(), None)
    names, home = list(sets), {}
    root = {s: s for s in names}

    def find(s):
        while root[s] is not s:
            s = root[s]
        return s

    for k, a in enumerate(names):
        for b in names[:k]:
            if find(a) is not find(b) and 100 * len(a & b) >= 80 * len(a | b):
                root[find(a)] = find(b)
    for s in names:
        home[find(s)] = min(home.get(find(s), 1 << 62), *sets[s])
    return sorted(
        (str(i), len(s), None if i is None else home[find(s)] if s in sets else i)
        for i, t in rows
        for s in [shingles(t, size)]
    )


def planted(seed, n=40):
    rng = random.Random(seed)
    words = [f"W{i}" for i in range(400)]
    rows = []
    for i in range(n):
        base = [rng.choice(words) for _ in range(rng.randint(1, 80))]
        rows.append((i * 10, " ".join(base)))
        for k in range(rng.choice([0, 0, 1, 3])):
            near = list(base)
            for _ in range(max(0, len(near) // 25 * k)):
                near[rng.randrange(len(near))] = rng.choice(words)
            rows.append((i * 10 + k + 1, "\t".join(near).lower() + " \n"))
    return rows


def result(spark, rows, size=2):
    frame = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as node", "'x' as class").repartition(3)
    got = op.near_components(frame, "doc_id", "text", size).collect()
    assert all(r.kept == (r.id == r.component_id) for r in got if r.id is not None)
    return sorted((str(r.id), r.n_shingles, r.component_id) for r in got)


def test_nulls_ties_empty_short_and_near(spark):
    rows = planted(1) + [(None, "a b c"), (5000, None), (5001, " \n"), (5002, "One"), (5003, "one"), (5003, "one"), (0, "a b c")]
    rows += [(6000, "É b"), (6001, "é b"), (6002, " ".join(["x", "y"] * 30_000))]
    assert result(spark, rows) == brute(rows, 2)
    none = spark.createDataFrame([], "doc_id long, text string")
    assert op.near_components(none, "doc_id", "text").collect() == []


def test_large_nodes_and_large_groups(spark, monkeypatch):
    monkeypatch.setattr(op, "LEAF", 8)
    monkeypatch.setattr(op, "GROUP_SETS", 6)
    rng = random.Random(3)
    base = [f"w{i}" for i in range(120)]
    rows = [(500 + i, t) for i, t in planted(2, 15)]
    for i in range(40):
        near = list(base)
        for _ in range(rng.randint(0, 5)):
            near[rng.randrange(120)] = f"z{rng.randrange(50)}"
        rows.append((i, " ".join(near)))
    got, want = result(spark, rows, 2), brute(rows, 2)
    assert [g[:2] for g in got] == [w[:2] for w in want]
    assert sum(g != w for g, w in zip(got, want)) <= 1  # trees reach a target recall


def test_large_groups_lose_no_link(spark, monkeypatch):
    for name, value in {"LEAF": 6, "GROUP_SETS": 6, "TREES": 4, "BLOCK_SETS": 7}.items():
        monkeypatch.setattr(op, name, value)
    rng = random.Random(5)
    words, rows = [f"w{i}" for i in range(100)], []
    # a chain in which only neighbours may link, with copies close to some of its texts
    for i in range(40):
        for k in rng.sample(range(i % 3, 100, 3), rng.choice([5, 5, 5, 6])):
            words[k] = f"n{i}k{k}"
        rows.append((10 * i, " ".join(words)))
        for n in range(1, rng.choice([1, 4])):
            near = list(words)
            near[rng.randrange(100)] = f"m{n}"
            rows.append((10 * i + n, " ".join(near)))
    want = brute(rows, 2)
    assert 3 < len({w[2] for w in want}) < 40
    assert result(spark, rows, 2) == want


def test_near_copies_take_few_rounds_and_tables(spark, monkeypatch):
    for name, value in {"LEAF": 32, "GROUP_SETS": 64, "BLOCK_SETS": 64}.items():
        monkeypatch.setattr(op, name, value)
    names = []

    def counted(frame, name):
        names.append(name)
        return written(frame, name)

    for module in (op, common, parts):
        monkeypatch.setattr(module, "written", counted)
    rng = random.Random(9)
    vocabulary = [f"w{i}" for i in range(2000)]
    base, rows = rng.choices(vocabulary, k=60), []
    for i in range(900):
        near = list(base) if i % 3 else rng.choices(vocabulary, k=60)
        for _ in range(2):
            near[rng.randrange(60)] = rng.choice(vocabulary)
        rows.append((i, " ".join(near)))
    got, want = result(spark, rows, 2), brute(rows, 2)
    assert got == want
    assert sum(n.startswith("op8-large") for n in names) <= 3 and len(names) <= 40


@pytest.mark.parametrize("size", [1, 2, 5])
def test_shingle_sets(size):
    texts = ["", "a", "a b", "a b c d e f", "A B a b A b", "x " * 50]
    got = op.shingle_sets(op.scan([t.encode() for t in texts], lower=True), size)
    assert [len(s) for s in got] == [len(shingles(t, size)) for t in texts]


def test_confirmed_leaves_out_no_link():
    rng = np.random.default_rng(8)
    sets = [np.sort(rng.choice(60, rng.integers(1, 50), replace=False)).astype(np.uint64) for _ in range(80)]
    links = list(op.confirmed(np.arange(80), sets))
    root = list(range(80))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in links:
        assert op.linked(sets[a], sets[b])
        root[find(a)] = find(b)
    for a in range(80):
        for b in range(a):
            assert not op.linked(sets[a], sets[b]) or find(a) == find(b)


def test_components(spark):
    rng = random.Random(6)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)] + [(i, i + 1) for i in range(400, 440)] + [(7, 7)]
    frame = spark.createDataFrame(links, "a long, b long").repartition(3)
    got = {r.id: r.component for r in components(frame, "t").collect()}
    root = {x: x for link in links for x in link}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in links:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    assert got == {x: find(x) for link in links if link[0] != link[1] for x in link}
    assert components(frame.limit(0), "t").collect() == []


def test_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    got = op.op8_near_dedup(spark, SMALL)
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert sorted((str(r.doc_id), r.n_shingles, r.component_id) for r in got.collect()) == brute(rows, 2)
