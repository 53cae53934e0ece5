"""Links and components of vectors against all pairs."""

from __future__ import annotations

import contextlib
import threading
from pathlib import Path

import numpy as np
import pytest

from tickloom.llm import op2_embedding_dedup as op

SMALL = "/root/testdata/sf0.001"


def brute(keys, vectors):
    rows = []
    for v in vectors:
        x = None if v is None or any(c is None for c in v) else np.array(v, np.float64)
        rows.append(x if x is not None and len(x) and np.isfinite(x).all() and x.any() else None)
    links = {i: set() for i in range(len(rows))}
    good = [i for i, x in enumerate(rows) if x is not None]
    made = np.array([rows[i] / np.abs(rows[i]).max() for i in good])
    made = made / np.linalg.norm(made, axis=1)[:, None]
    for a, b in zip(*np.nonzero(made @ made.T >= op.COSINE)):
        if a != b:
            links[good[a]].add(good[b])
    out, seen = [None] * len(rows), set()
    for i in range(len(rows)):
        if i in seen:
            continue
        group, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()] - group:
                group.add(j)
                todo.append(j)
        seen |= group
        named = [keys[j] for j in group if keys[j] is not None]
        for j in group:
            out[j] = (keys[j], len(links[j]), min(named) if named else None)
    return out


def result(spark, rows):
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, block string").repartition(3)
    return [(r.vec_id, r.n_links, r.component_id, r.kept) for r in op.near_vectors(frame, "vec_id", "embedding").collect()]


def ranked(rows):
    return sorted(rows, key=str)


@pytest.mark.parametrize("block", [16, 4096])
def test_against_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(op, "BLOCK", block)
    rng = np.random.default_rng(block)
    base = rng.normal(size=(6, 8))
    vectors = [base[rng.integers(6)] + rng.normal(size=8) * s for s in rng.choice([0.0, 0.05, 0.3, 0.6], 150)]
    vectors += [list(3 * base[0]), list(base[0]), list(base[0] * 1e-200), [0.0] * 8]
    rows = [(i * 7 % 1000, [float(x) for x in v], "x") for i, v in enumerate(vectors)]
    rows += [(None, rows[0][1], None), (rows[1][0], rows[1][1], "x"), (2000, None, "x"), (2001, [float("nan")] * 8, "x")]
    rows += [(2002, [None] * 8, "x"), (2003, [float("inf")] + [1.0] * 7, "x"), (2004, [], "x")]
    want = brute([r[0] for r in rows], [r[1] for r in rows])
    got = result(spark, rows)
    assert ranked([g[:3] for g in got]) == ranked(want)
    assert all(kept == (key == home) for key, _, home, kept in got if key is not None)


def test_chains_and_nothing_usable(spark):
    step = np.deg2rad(20.0)  # cos 20 is 0.94, cos 40 is 0.77
    rows = [(9 - i, [float(np.cos(i * step)), float(np.sin(i * step))], "x") for i in range(5)]
    assert {r[2] for r in result(spark, rows)} == {5}
    assert sorted(r[1] for r in result(spark, rows)) == [1, 1, 2, 2, 2]
    assert result(spark, [(1, None, "x"), (None, [0.0], "x")]) in (
        [(1, 0, 1, True), (None, 0, None, True)],
        [(None, 0, None, True), (1, 0, 1, True)],
    )
    assert result(spark, []) == []


def test_tree_levels_are_nested_and_cover():
    rows = np.random.default_rng(3).normal(size=(200, 4))
    rows /= np.linalg.norm(rows, axis=1)[:, None]
    nodes = op.tree(rows)
    for level, radius in enumerate(op.RADII):
        off = np.linalg.norm(rows - rows[nodes[:, level]], axis=1)
        assert off.max() <= radius + 1e-7
        assert (nodes[nodes[:, level], level] == nodes[:, level]).all()
        if level:
            assert set(nodes[:, level - 1]) <= set(nodes[:, level])


def test_query(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()]
    got = op.op2_embedding_dedup(spark, SMALL)
    assert got.columns == ["vec_id", "n_links", "component_id", "kept"]
    want = brute([r[0] for r in rows], [r[1] for r in rows])
    assert ranked([tuple(r)[:3] for r in got.collect()]) == ranked(want)


def test_disk_does_not_grow_with_pairs_of_blocks(spark, monkeypatch):
    monkeypatch.setattr(op, "BLOCK", 32)
    rng = np.random.default_rng(4)
    made = rng.normal(size=(1600, 64))  # without neighbours, so that no two blocks are apart
    made[1000:1040] = 2 * made[:40] + rng.normal(size=(40, 64)) * 0.1
    rows = [(i, v, "x") for i, v in enumerate(made.tolist())]
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    folders = [Path(str(d)) for d in manager.localDirs()]
    old, seen, done = {f for d in folders for f in d.rglob("*shuffle_*")}, {}, threading.Event()

    def watch():  # Spark may delete a shuffle as soon as it was read
        while not done.wait(0.02):
            for f in {f for d in folders for f in d.rglob("*shuffle_*.data*")} - old:
                with contextlib.suppress(OSError):
                    name = f.name.partition(".data")[0]
                    seen[name] = max(seen.get(name, 0), f.stat().st_size)

    watcher = threading.Thread(target=watch)
    watcher.start()
    try:
        got = result(spark, rows)
    finally:
        done.set()
        watcher.join()
    assert sum(seen.values()) < 3 * made.nbytes
    assert ranked([g[:3] for g in got]) == ranked(brute([r[0] for r in rows], [r[1] for r in rows]))
    assert sum(g[1] for g in got) == 80


@pytest.mark.parametrize("spread", [0.0, 0.1, 0.2, 0.33, 0.6, 9.0])
def test_traversal_against_all_pairs(spread):
    rng = np.random.default_rng(int(spread * 100))
    base = rng.normal(size=(3, 32))
    left, right = (base[rng.integers(3, size=n)] + spread * rng.normal(size=(n, 32)) for n in (700, 300))
    right[:40] = left[:40] * 3
    axes = op.leading(op.scaled(left[:200])) if spread else np.linalg.qr(rng.normal(size=(32, 7)))[0]
    one, two = (op.Side(x, op.tree(op.scaled(x)), axes) for x in (left, right))
    for a, b, same in ((one, two, False), (one, one, True)):
        want = a.rows @ b.rows.T >= op.COSINE
        if same:
            np.fill_diagonal(want, False)
        found = op.traverse(a, b, same)
        mine, theirs = found.totals()
        assert mine.tolist() == want.sum(axis=1).tolist()
        assert same or theirs.tolist() == want.sum(axis=0).tolist()
        x, y = np.nonzero(want)
        assert op.roots(found.n, *found.links()).tolist() == op.roots(found.n, x, y + found.offset).tolist()


def test_short_products_are_no_less_than_cosines():
    rng = np.random.default_rng(8)
    rows = op.scaled(rng.normal(size=(600, 64)) + 0.1)
    axes = op.leading(rows[:400])
    low = op.shortened(rows, axes)
    assert 1 < low.shape[1] < 64
    assert (low @ low.T - rows @ rows.T).min() > -op.rounding(low.shape[1])
