"""Mixing sources to target weights by entropy balancing."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm.common import fresh, table, word_count
from tickloom.session import written

WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
MOST_COPIES = 2
BLOCK_ROWS = 2000

Value = str | None


def targets(sizes: dict[Value, int], weights: tuple[float, ...], share: float, most: float) -> dict[Value, float]:
    """Target sizes of the sources, given one size for each source.

    Sources in order of their names' code points, null last, weigh ``weights`` in turn and
    share ``share`` times the total size. A target stops at ``most`` times its source's size;
    what is over goes to the others by weight, until none is above.
    """
    order = sorted(sizes, key=lambda s: (s is None, [ord(c) for c in s or ""]))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, free, got = share * sum(sizes.values()), list(order), {}
    while free:
        level = left / sum(weight[s] for s in free)
        full = [s for s in free if level * weight[s] > most * sizes[s]]
        if not full:
            return got | {s: level * weight[s] for s in free}
        for s in full:
            got[s] = float(most * sizes[s])
            left -= got[s]
        free = [s for s in free if s not in got]
    return got


def balance(
    documents: DataFrame,
    size: str,
    wanted: dict[str, dict[Value, float]],
    most: float,
    tolerance: float = 1e-7,
    steps: int = 60,
) -> dict[str, dict[Value, float]]:
    """Multipliers of the rates ``most * sigmoid(sum of multipliers)``, one for each constraint.

    ``wanted`` gives, for one or more columns, the tokens that the documents with each value
    shall have together. Of all rates between 0 and ``most`` that meet these constraints, the
    result has the largest entropy, token by token; that is why a document's rate depends on
    its values and not on its length. The dual is convex and has one multiplier for each
    constraint. Each Newton step is one Spark aggregation over the documents' cells
    (documents with the same values, summed before the shuffle), which returns sums for each
    constraint and for each pair of them; the driver solves the small system and halves a
    step that leads away. The number of constraints is what a person sets as targets; it
    does not grow with the documents. A target at or above ``most`` times its tokens, or at
    0, has an infinite multiplier.
    """
    columns = list(wanted)
    cells = written(
        documents.groupBy(*columns).agg(F.sum(size).cast("double").alias("_tokens")), "op3-cells"
    )
    lam: dict[str, dict[Value, float]] = {c: {} for c in columns}
    free: list[tuple[str, Value]] = []
    for c in columns:
        have = {r[0]: r[1] for r in cells.groupBy(c).agg(F.sum("_tokens")).collect()}
        for value, tokens in have.items():
            target = wanted[c].get(value, 0.0)
            if target >= most * tokens:
                lam[c][value] = math.inf
            elif target <= 0:
                lam[c][value] = -math.inf
            else:
                lam[c][value] = 0.0
                free.append((c, value))
    at = {key: i for i, key in enumerate(free)}
    goal = np.array([wanted[c][v] for c, v in free])
    last = math.inf
    before, step = np.zeros(len(free)), np.zeros(len(free))
    for _ in range(steps if free else 0):
        rated = cells.withColumn("_rate", rate(columns, lam, most))
        slope = F.col("_rate") * (1 - F.col("_rate") / most) * F.col("_tokens")
        have, matrix = np.zeros(len(free)), np.zeros((len(free), len(free)))
        for i, c in enumerate(columns):
            for d in columns[i:]:
                sums = rated.groupBy(F.col(c).alias("_c"), F.col(d).alias("_d")).agg(
                    F.sum(F.col("_rate") * F.col("_tokens")).alias("_sum"), F.sum(slope).alias("_slope")
                )
                for r in sums.collect():
                    a, b = at.get((c, r["_c"])), at.get((d, r["_d"]))
                    if c == d and a is not None:
                        have[a] += r["_sum"]
                    if a is not None and b is not None:
                        matrix[a, b] += r["_slope"]
                        matrix[b, a] = matrix[a, b]
        off = goal - have
        worst = float(np.max(np.abs(off) / goal))
        if worst < tolerance:
            break
        if worst > last and np.abs(step).max() > 1e-9:
            step = step / 2
        else:
            last, before = worst, np.array([lam[c][v] for c, v in free])
            damp = np.eye(len(free)) * 1e-12 * max(1.0, float(np.trace(matrix)))
            step = np.clip(np.linalg.lstsq(matrix + damp, off, rcond=None)[0], -2, 2)
        for (c, v), x in zip(free, before + step, strict=True):
            lam[c][v] = float(x)
    return lam


def rate(columns: list[str], lam: dict[str, dict[Value, float]], most: float):
    """The rate of a document as a column; a value without a constraint counts as 0 tokens."""
    total = F.lit(0.0)
    for c in columns:
        finite = {v: x for v, x in lam[c].items() if v is not None}
        pairs = [F.lit(x) for item in finite.items() for x in item]
        known = F.create_map(*pairs)[F.col(c)] if pairs else F.lit(None).cast("double")
        total = total + F.when(F.col(c).isNull(), F.lit(lam[c].get(None, -math.inf))).otherwise(
            F.coalesce(known, F.lit(-math.inf))
        )
    return F.when(total == -math.inf, 0.0).otherwise(most / (1 + F.exp(-total)))


def rounded_sizes(sizes: np.ndarray, rates: np.ndarray, most: int = MOST_COPIES) -> np.ndarray:
    """Whole copies near the rates, for sizes in falling order.

    Each document gets the whole number next below or above its rate, whichever brings the
    tokens so far nearer to what the rates ask. Then ``settled`` gives or takes single copies
    while that brings the sum nearer. At the end no single copy, given or taken, does: what is
    off is at most half of the smallest size that can still be given or taken in its direction.
    """
    copies, off = np.floor(rates).astype(np.int64), 0.0
    for i, (size, part) in enumerate(zip(sizes.tolist(), (rates - copies).tolist(), strict=True)):
        off -= part * size
        if part > 0 and abs(off + size) < abs(off):
            copies[i] += 1
            off += size
    return settled(sizes, copies, off, most)


def settled(sizes: np.ndarray, copies: np.ndarray, off: float, most: int) -> np.ndarray:
    """Copies after the moves that bring ``off``, what they have too much, nearest to 0.

    A move gives or takes one copy, or does both for two documents. Each is the best one of
    its kind, the first of equals, and single copies are preferred; each brings ``off`` nearer.
    """
    while abs(off) > 0.5:
        sign = 1 if off < 0 else -1
        free = (copies < most if sign > 0 else copies > 0) & (sizes > 0)
        back = (copies > 0 if sign > 0 else copies < most) & (sizes > 0)
        one, other = np.flatnonzero(free), np.flatnonzero(back)
        if not len(one):
            break
        left = np.abs(off + sign * sizes[one])
        i = int(left.argmin())
        if left[i] < abs(off) - 1e-9:
            copies[one[i]] += sign
            off += sign * float(sizes[one[i]])
            continue
        # two documents whose sizes differ by about what is off; sizes fall, so -sizes rises
        want = sizes[one] - abs(off)
        at = np.clip(np.searchsorted(-sizes[other], -want), 0, max(len(other) - 1, 0)) if len(other) else None
        if at is None:
            break
        tries = [(abs(off + sign * (sizes[one] - sizes[other[a]])), a) for a in (at, np.maximum(at - 1, 0))]
        left, a = min(tries, key=lambda t: t[0].min())
        i = int(left.argmin())
        if left[i] >= abs(off) - 1e-9:
            break
        copies[one[i]] += sign
        copies[other[a[i]]] -= sign
        off += sign * float(sizes[one[i]] - sizes[other[a[i]]])
    return copies


def mix_copies(documents: DataFrame, key: str, source: str, size: str, wanted: dict[Value, float], most: int) -> DataFrame:
    """Adds ``copies``, the number of times the mix takes each document.

    Rates come from ``balance`` over the one column ``source``, so all documents of a source
    have the same rate. They are rounded in blocks of about BLOCK_ROWS documents of a source,
    cut by a hash, so that a source of any size is spread over many tasks; each block comes as
    near to its part of the target as single copies, and exchanges of two, can bring it.
    Documents of size 0 get the rate's whole part. ``key`` settles ties in size; rows that are
    equal in key and size may swap their copies. Null sources are a source of their own.
    """
    lam = balance(documents, size, {source: wanted}, most)
    counts = documents.groupBy(source).agg(F.count(F.lit(1)).alias("_n")).withColumnRenamed(source, "_s")
    # one row for each source, as many as there are targets
    rated = documents.join(F.broadcast(counts), documents[source].eqNullSafe(F.col("_s"))).drop("_s")
    block = F.pmod(F.xxhash64(F.col(key), F.col(size)), F.ceil(F.col("_n") / BLOCK_ROWS))
    rated = rated.withColumns({"_rate": rate([source], lam, most), "_block": block})
    name = fresh(documents.columns, "copies")
    schema = f"{documents.select(key, source, size).schema.simpleString()[7:-1]},{name}:bigint"
    columns = [key, source, size]

    def settle(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values([size, key], ascending=[False, True], kind="stable")
        frame[name] = rounded_sizes(frame[size].to_numpy(), frame["_rate"].to_numpy(), most)
        return frame[[*columns, name]]

    return (
        rated.select(*columns, "_rate", "_block")
        .groupBy(source, "_block")
        .applyInPandas(settle, schema)
    )


def source_targets(documents: DataFrame, source: str, size: str) -> tuple[dict[Value, int], dict[Value, float]]:
    """Sizes and targets of all sources: one row for each source comes to the driver."""
    have = {r[0]: r[1] for r in documents.groupBy(source).agg(F.sum(size)).collect()}
    return have, targets(have, WEIGHTS, SHARE, MOST_COPIES)


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, mixed to the sources' targets by at most two copies of each."""
    sized = written(
        table(spark, sf_dir, "documents").select("doc_id", "source", word_count(F.col("text")).alias("size")),
        "op3-sizes",
    )
    have, wanted = source_targets(sized, "source", "size")
    mixed = mix_copies(sized, "doc_id", "source", "size", wanted, MOST_COPIES)
    rows = [(s, n, wanted[s]) for s, n in have.items()]
    found = spark.createDataFrame(rows, "_s string, source_size long, target double")
    # one row for each source
    return mixed.join(F.broadcast(found), F.col("source").eqNullSafe(F.col("_s"))).select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (F.col("copies") * F.col("size")).alias("taken"),
        "copies",
    )
