"""Shards against a brute-force search of the smallest capacity."""

from __future__ import annotations

import random
import zlib

import pytest
from pyspark.sql import functions as F

from tickloom.llm.common import running
from tickloom.llm.op1_sharding import Block, Boundaries, minimax_cuts, op1_sharding, shard_groups

SMALL = "/root/testdata/sf0.001"


def smallest_capacity(sizes, shards):
    """By dynamic programming over all contiguous partitions."""
    ends = [0]
    for s in sizes:
        ends.append(ends[-1] + s)
    best = [0] + [float("inf")] * len(sizes)
    for _ in range(shards):
        best = [min(max(best[j], ends[i] - ends[j]) for j in range(i + 1)) for i in range(len(ends))]
    return best[-1]


@pytest.mark.parametrize("seed", range(6))
@pytest.mark.parametrize("blocks", [4, 16, 1 << 16])
def test_capacity_is_the_smallest(spark, seed, blocks):
    rng = random.Random(seed)
    sizes = [rng.choice([1, 2, 3, 5, 40]) for _ in range(rng.randint(3, 60))]
    shards = rng.randint(2, 7)
    ends = [sum(sizes[:i]) for i in range(len(sizes) + 1)]
    groups = spark.createDataFrame(list(zip(ends, sizes)), "start long, size long").coalesce(1)
    cuts = [0, *minimax_cuts(groups, shards, blocks), ends[-1]]
    assert all(c in ends for c in cuts) and cuts == sorted(cuts)
    assert max(b - a for a, b in zip(cuts, cuts[1:])) == smallest_capacity(sizes, shards)


def test_even_cuts_do_not_leave_the_last_shard_short():
    known = Boundaries([Block(i, i - 1, 0, 0) for i in range(1, 103)])
    cuts = [0, *known.even(known.smallest(10, False), 10), 102]
    assert {b - a for a, b in zip(cuts, cuts[1:])} == {10, 11}


def test_running_sums(spark):
    rows = [(None, 5), (3, 1), (1, 2), (2, 4), (7, 8)]
    frame = spark.createDataFrame(rows, "k long, v long").repartition(3)
    got = running(frame, ["k"], {"s": F.col("v"), "n": F.lit(1)}, "t").collect()
    assert sorted((r.k or 0, r.s, r.n) for r in got) == [(0, 0, 0), (1, 5, 1), (2, 7, 2), (3, 11, 3), (7, 12, 4)]


def test_groups_stay_together_and_slots_have_no_gaps(spark):
    rows = [(i, "a" if i % 3 else f"t{i}", 10) for i in range(50)] + [(None, None, 16), (None, None, 16), (7, "a", 10)]
    frame = spark.createDataFrame(rows, "doc_id long, g string, size long").withColumn("shard2", F.lit(1))
    got = shard_groups(frame, "g", "doc_id", "size", 4).collect()
    assert len(got) == len(rows)
    homes, slots = {}, {}
    for r in got:
        homes.setdefault(r.g, set()).add(r.shard)
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(len(v) == 1 for v in homes.values())
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())


def test_empty_table(spark):
    frame = spark.createDataFrame([], "doc_id long, g string, size long")
    assert shard_groups(frame, "g", "doc_id", "size", 4).collect() == []


def test_query(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    frame = op1_sharding(spark, SMALL)
    assert frame.columns[:7] == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    got = {r.doc_id: r for r in frame.collect()}
    assert got.keys() == docs.keys()
    bytes_of, groups, order = [0] * 40, {}, {}
    for i, text in sorted(docs.items()):
        raw = text.encode()
        assert (got[i].size, got[i].text_crc32) == (len(raw) + 16, zlib.crc32(raw))
        bytes_of[got[i].shard] += got[i].size
        groups.setdefault(text, set()).add(got[i].shard)
        order[text] = order.get(text, 0) + got[i].size
    assert all(len(s) == 1 for s in groups.values())
    assert max(bytes_of) == smallest_capacity(list(order.values()), 40)
