"""Sharding by minimax contiguous partition of ordered atomic groups."""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterable
from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm.common import running, table
from tickloom.session import written

SHARDS = 40
ROW_BYTES = 16


class Block(NamedTuple):
    """Consecutive groups, by their running sizes: those whose start has the same ``start >> shift``."""

    end: int
    begin: int
    inner: int  # ends of groups inside, of which the driver does not know where they are
    shift: int


class Boundaries:
    """The ends of blocks of groups, and which blocks hide further ends."""

    def __init__(self, blocks: Iterable[Block]):
        self.blocks = sorted(blocks)
        self.ends = [b.end for b in self.blocks]
        self.hidden = [b.inner > 0 for b in self.blocks]

    def reach(self, at: int, capacity: int, hopeful: bool) -> int:
        """The furthest end within the capacity; a hopeful one takes hidden ends where it likes."""
        i = bisect_right(self.ends, at + capacity)
        known = self.ends[i - 1] if i else 0
        return at + capacity if hopeful and i < len(self.ends) and self.hidden[i] else known

    def between(self, low: int, high: int, shards: int) -> list[Block]:
        """Blocks with hidden ends that a greedy cut may fall into at a capacity from low to high."""
        found: set[Block] = set()
        nearest, furthest = self.greedy(low, shards, False), self.greedy(high, shards, True)
        for least, most in zip(nearest, furthest, strict=True):
            upto = bisect_right(self.ends, most) + 1
            found.update(b for b in self.blocks[bisect_left(self.ends, least) : upto] if b.inner)
        return list(found)

    def greedy(self, capacity: int, shards: int, hopeful: bool) -> list[int]:
        """Ends of the shards when each is filled as far as the capacity goes."""
        cuts, at = [], 0
        for _ in range(shards):
            at = min(max(at, self.reach(at, capacity, hopeful)), self.ends[-1])
            cuts.append(at)
        return cuts

    def smallest(self, shards: int, hopeful: bool) -> int:
        """Binary search of the smallest capacity under which the greedy filling ends in time."""
        total = self.ends[-1]
        low, high = -(-total // shards), total
        while low < high:
            middle = (low + high) // 2
            if self.greedy(middle, shards, hopeful)[-1] == total:
                high = middle
            else:
                low = middle + 1
        return low

    def even(self, capacity: int, shards: int) -> list[int]:
        """Cuts under the capacity, each as near to equal sizes as the others leave it."""
        total = self.ends[-1]
        latest = [total]
        for _ in range(shards - 1):
            i = bisect_left(self.ends, latest[-1] - capacity)
            latest.append(self.ends[i] if latest[-1] > capacity else 0)
        cuts, at = [], 0
        for k, least in enumerate(reversed(latest[1:]), 1):
            least, most = max(least, at), self.reach(at, capacity, False)
            ideal = k * total // shards
            i = bisect_left(self.ends, ideal)
            near = [e for e in (*self.ends[max(0, i - 1) : i + 1], 0) if least <= e <= most]
            at = min(near, key=lambda e: abs(e - ideal)) if near else (least if ideal < least else most)
            cuts.append(at)
        return cuts


def minimax_cuts(groups: DataFrame, shards: int, max_blocks: int = 1 << 16) -> list[int]:
    """Running sizes at which the shards after the first begin.

    ``groups`` has ``start`` and ``size`` (positive), one row for each atomic group in
    order. The driver never sees all groups: it holds the ends of at most about
    ``max_blocks`` blocks of consecutive groups, from which it gets a lower and an upper
    bound of the smallest capacity. Only blocks that a cut could fall into under a
    capacity between the bounds are split further, until the bounds meet, so the capacity
    is exact for any number of groups.
    """
    total = groups.agg(F.sum("size")).first()[0]
    if total is None:
        return [0] * (shards - 1)

    def blocks(frame: DataFrame, shift: int) -> DataFrame:
        key = F.shiftright("start", shift)
        return frame.groupBy(key.alias("key")).agg(
            F.max(F.col("start") + F.col("size")).alias("end"),
            F.min("start").alias("begin"),
            (F.count(F.lit(1)) - 1).alias("inner"),
            F.lit(shift).alias("shift"),
        ).drop("key")

    first = max(0, (total - 1).bit_length() - (max_blocks.bit_length() - 1))
    known = Boundaries(Block(*row) for row in blocks(groups, first).collect())
    while True:
        low, high = known.smallest(shards, True), known.smallest(shards, False)
        opened = known.between(low, high, shards) if low < high else []
        if not opened:
            return known.even(high, shards)
        by = max(1, (max_blocks // len(opened)).bit_length() - 1)
        finer = []
        for shift in sorted({b.shift for b in opened}):
            ids = [(b.begin >> shift,) for b in opened if b.shift == shift]
            # no more rows than the driver holds blocks
            chosen = F.broadcast(groups.sparkSession.createDataFrame(ids, "_id long"))
            inside = groups.join(chosen, F.shiftright("start", shift) == F.col("_id"), "left_semi")
            finer.append(blocks(inside, max(0, shift - by)))
        rows = reduce(DataFrame.unionByName, finer).collect()
        known = Boundaries([*set(known.blocks).difference(opened), *(Block(*row) for row in rows)])


def shard_groups(rows: DataFrame, group: str, order: str, size: str, shards: int) -> DataFrame:
    """Adds ``shard`` and ``slot`` to rows, with all rows of a group in one shard.

    Groups are ordered by their smallest ``order`` value (nulls first) and cut into
    contiguous shards so that the largest shard is as small as it can be; among such
    cuts, those nearest to equal sizes are taken. ``slot`` counts the rows of a shard
    from 0 in the order of groups, then of ``order``. Sizes must be positive. A group that
    is larger than an equal share makes its shard that large. An empty table stays empty;
    with fewer groups than shards some shards are empty. Equal rows may swap their slots.
    """
    spark = rows.sparkSession
    groups = rows.groupBy(group).agg(F.min(order).alias("_first"), F.sum(size).alias("size"))
    placed = written(running(groups, ["_first", group], {"start": F.col("size")}, "op1-groups"), "op1-starts")
    cuts = minimax_cuts(placed.select("start", "size"), shards)
    before = F.filter(F.lit(cuts).cast("array<long>"), lambda c: c <= F.col("start"))
    shard = F.size(before) if cuts else F.lit(0)
    # rows keep a group's place; a group that holds many rows is split by the join's skew handling
    marked = placed.select(F.col(group).alias("_group"), "_first", shard.cast("int").alias("shard"))
    joined = rows.join(marked, rows[group].eqNullSafe(marked["_group"])).drop("_group")
    counted = running(joined, ["shard", "_first", group, order], {"_place": F.lit(1)}, "op1-rows")
    first = counted.groupBy("shard").agg(F.min("_place").alias("_base"))
    # one row for each shard
    return (
        counted.join(F.broadcast(first), "shard")
        .withColumn("slot", F.col("_place") - F.col("_base"))
        .select(*rows.columns, "shard", "slot")
    )


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 40 shards; equal texts stay together."""
    text = F.col("text")
    rows = written(
        table(spark, sf_dir, "documents").select(
            "doc_id",
            (F.coalesce(F.octet_length(text), F.lit(0)) + ROW_BYTES).cast("long").alias("size"),
            F.crc32(F.encode(text, "utf-8")).alias("text_crc32"),
            F.unhex(F.sha2(text, 256)).alias("text_digest"),
        ),
        "op1-sizes",
    )
    return shard_groups(rows, "text_digest", "doc_id", "size", SHARDS).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
