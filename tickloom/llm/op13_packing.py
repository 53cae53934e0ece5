"""Packing documents into training sequences by cutting-stock column generation."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tickloom.llm.common import running, table
from tickloom.llm.op5_token_files import encode
from tickloom.session import written

END_ID = 2
SEQUENCE = 4096
UNITS = 256  # a sequence is so many units, and a document's length is rounded up to whole ones
UNIT = SEQUENCE // UNITS
NEAR_BOUND = 1e-3  # column generation ends when no more than this share, or one sequence, could be saved
MARGIN = 1.02  # more tokens are cut free than the gaps of the other sequences take


class Pattern(NamedTuple):
    """``counts[c]`` documents of c + 1 units in each of ``copies`` sequences."""

    counts: np.ndarray
    copies: int

    def units(self) -> int:
        return int(self.counts @ np.arange(1, len(self.counts) + 1))


def knapsack(worth: np.ndarray, most: np.ndarray | None = None) -> tuple[float, np.ndarray]:
    """The counts of lengths 1, 2, ... that fit into one sequence and are worth most, by dynamic programming.

    Without ``most`` a length may be taken any number of times, and the best of every
    capacity follows from those below it. With it, lengths come in turn, in powers of two
    of their number, and what was taken is traced back.
    """
    n = len(worth)
    counts = np.zeros(n, np.int64)
    if most is None:
        best, took = np.zeros(n + 1), np.zeros(n + 1, np.int64)
        for room in range(1, n + 1):
            value = best[room - 1 :: -1] + worth[:room]  # of length l, best[room - l] + worth[l - 1]
            at = int(value.argmax())
            best[room], took[room] = (value[at], at + 1) if value[at] > best[room - 1] else (best[room - 1], 0)
        room = n
        while room > 0:
            if took[room]:
                counts[took[room] - 1] += 1
                room -= int(took[room])
            else:
                room -= 1
        return float(best[n]), counts
    best, steps = np.zeros(n + 1), []
    for c in np.flatnonzero(most).tolist():
        left, part = min(int(most[c]), n // (c + 1)), 1
        while left > 0:
            part = min(part, left)
            weight = part * (c + 1)
            if weight <= n:
                value = best[: n + 1 - weight] + part * worth[c]
                better = np.zeros(n + 1, bool)
                better[weight:] = value > best[weight:] + 1e-12
                best[weight:] = np.maximum(best[weight:], value)
                steps.append((c, part, weight, better))
            left, part = left - part, 2 * part
    room = n
    for c, part, weight, better in reversed(steps):
        if better[room]:
            counts[c] += part
            room -= weight
    return float(best[n]), counts


def times(matrix: np.ndarray, vector: np.ndarray) -> np.ndarray:
    """Their product, without the threads of a linear algebra library, which may not outlive a fork."""
    return np.einsum("ij,j->i", matrix, vector)


def generated(demand: np.ndarray) -> list[tuple[np.ndarray, float]]:
    """Patterns and how often the linear program takes each, to cover the demand by the fewest sequences.

    The basis starts with patterns of one length. Its dual values price the lengths; the
    knapsack finds the pattern of most worth, which enters while it is worth more than one
    sequence. Prices are drawn towards the best ones so far, which start as the lengths
    themselves, since the basis' own swing widely; where these find no pattern that its own
    prices want, less so. What the demand is worth over what a sequence holds of it bounds
    the fewest sequences from below.
    """
    n = len(demand)
    here = np.flatnonzero(demand)
    if not len(here):
        return []
    need = demand[here].astype(float)
    # unequal by a trifle, so that no step of the simplex method ties and runs in circles
    need += 1e-5 * np.random.default_rng(0).random(len(here))
    best, fewest = (here + 1) / n, float(need @ (here + 1)) / n
    basis = np.diag((n // (here + 1)).astype(float))
    cost = np.ones(len(here))
    inverse = np.diag(1 / np.diag(basis))
    for _ in range(20 * len(here)):
        taken, price = times(inverse, need), times(inverse.T, cost)
        if cost @ taken - fewest <= max(1.0, NEAR_BOUND * fewest):
            break
        column, pays = np.zeros(len(here)), 1.0
        if price.min() < -1e-9:  # a length that the sequences hold too often: let places stay open
            column[price.argmin()], pays = -1.0, 0.0
        else:
            for drawn in (0.8, 0.4, 0.0):
                tried = np.zeros(n)
                tried[here] = drawn * best + (1 - drawn) * np.maximum(price, 0)
                value, counts = knapsack(tried)
                bound = float(tried[here] @ need) / max(value, 1.0)
                if bound > fewest:
                    fewest, best = bound, tried[here] / max(value, 1.0)
                column = counts[here].astype(float)
                if price @ column > 1 + 1e-9:
                    break
            else:
                break
        change = times(inverse, column)
        falls = change > 1e-9
        if not falls.any():
            break
        out = int(np.where(falls, np.maximum(taken, 0) / np.where(falls, change, 1), np.inf).argmin())
        basis[:, out], cost[out] = column, pays
        row = inverse[out] / change[out]
        inverse = inverse - np.outer(change, row)
        inverse[out] = row
    taken = np.maximum(times(inverse, need), 0)
    found = []
    for i in np.flatnonzero(cost).tolist():
        counts = np.zeros(n, np.int64)
        counts[here] = np.round(basis[:, i]).astype(np.int64)
        found.append((counts, float(taken[i])))
    return found


def patterns(demand: np.ndarray) -> list[Pattern]:
    """Patterns with whole numbers of copies that hold the demand exactly, fullest first.

    The linear program's copies are rounded down; the documents left over, at most about one
    sequence for each length, are packed one sequence at a time by the fullest pattern that
    they allow.
    """
    made, left = [], demand.astype(np.int64).copy()
    for counts, taken in generated(demand):
        copies = int(taken + 1e-6)
        used = counts > 0
        if copies and used.any():
            copies = min(copies, int((left[used] // counts[used]).min()))
        if copies:
            made.append(Pattern(counts, copies))
            left -= copies * counts
    worth = np.arange(1, len(demand) + 1).astype(float)
    while left.any():
        _, counts = knapsack(worth, left)
        used = counts > 0
        copies = int((left[used] // counts[used]).min())
        made.append(Pattern(counts, copies))
        left -= copies * counts
    return sorted(made, key=lambda p: -p.units())


def lay_out(items: DataFrame, made: list[Pattern], demand: np.ndarray) -> DataFrame:
    """Adds ``pattern``, ``sequence`` and ``slot`` to ranked items (``rank`` runs on over the lengths).

    Documents of one length take the places that the patterns have for it in the order of
    their ranks. The table of places has a row for each length of each pattern, so it is
    bounded by the number of units, whatever the documents are.
    """
    begin = np.concatenate([[0], np.cumsum(demand)[:-1]]).astype(np.int64)
    rows, sequence = [], 0
    for number, (counts, copies) in enumerate(made):
        slot = 0
        for c in np.flatnonzero(counts)[::-1].tolist():
            rows.append((int(begin[c]), int(counts[c]), sequence, slot, number))
            begin[c] += int(counts[c]) * copies
            slot += int(counts[c])
        sequence += copies
    places = np.array(sorted(rows), np.int64).reshape(-1, 5)

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            if not len(frame):
                continue
            rank = frame["rank"].to_numpy()
            start, per, first, slot, number = places[np.searchsorted(places[:, 0], rank, side="right") - 1].T
            frame["pattern"], frame["sequence"] = number, first + (rank - start) // per
            frame["slot"] = slot + (rank - start) % per
            yield frame

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in items.schema)
    return items.mapInPandas(work, f"{fields}, pattern long, sequence long, slot long")


def kept_sequences(made: list[Pattern], tokens: dict[int, int]) -> int:
    """How many sequences stay as patterned, given the patterns' tokens.

    The others, from the least full pattern on, are cut free to fill the gaps of these.
    """
    kept = sum(p.copies for p in made)
    room = SEQUENCE * kept - sum(tokens.values())
    free = 0.0
    for i in range(len(made) - 1, -1, -1):
        each = tokens.get(i, 0) / made[i].copies
        # giving up one sequence frees its tokens, and its own gap is one less to fill
        short = MARGIN * room - free
        if short <= 0:
            break
        gain = each + MARGIN * (SEQUENCE - each)
        given = min(made[i].copies, int(np.ceil(short / gain)))
        kept -= given
        free += given * each
        room -= given * (SEQUENCE - each)
    return kept


def overlaid(gaps: DataFrame, fillers: DataFrame) -> DataFrame:
    """Where two rows of stretches on one line (``at``, ``length``) overlap: ``low`` and ``high``.

    Both are dealt to cells of one sequence's length, of which each stretch, no longer than
    that, touches two at most; a pair counts in the cell that its overlap begins in.
    """

    def dealt(rows: DataFrame, side: str) -> DataFrame:
        last = F.col("at") + F.col("length") - 1
        cells = F.array_distinct(F.array(F.floor(F.col("at") / SEQUENCE), F.floor(last / SEQUENCE)))
        names = [F.col(c).alias(f"{side}_at" if c == "at" else f"{side}_length" if c == "length" else c) for c in rows.columns]
        return rows.select(*names, F.explode(cells).alias("cell"))

    both = dealt(gaps, "gap").join(dealt(fillers, "fill"), "cell")
    low = F.greatest("gap_at", "fill_at")
    high = F.least(F.col("gap_at") + F.col("gap_length"), F.col("fill_at") + F.col("fill_length"))
    return both.withColumns({"low": low, "high": high}).filter(
        (F.col("low") < F.col("high")) & (F.floor(F.col("low") / SEQUENCE) == F.col("cell"))
    )


def packed(lengths: DataFrame) -> DataFrame:
    """Pieces (``row``, ``start``, ``length``, ``sequence_id``, ``offset``) of documents (``row``, ``n_tokens``).

    Whole sequences are cut off long documents first. The rest of each document, shorter than
    a sequence, is a length of the histogram that column generation makes patterns for. Ranked
    documents take the patterns' places. The least full sequences are cut free again, and
    their documents, laid end to end, fill the gaps that the others have; what is over makes
    sequences of its own, at last of powers of two. So almost all documents stay whole, and
    padding is next to none. ``n_tokens`` is 1 or more; a document of none has no piece.
    """
    spark = lengths.sparkSession
    sized = lengths.withColumns(
        {"blocks": F.floor(F.col("n_tokens") / SEQUENCE), "rest": (F.col("n_tokens") % SEQUENCE).cast("long")}
    )
    items = sized.filter("rest > 0").select("row", "blocks", "rest", F.ceil(F.col("rest") / UNIT).alias("units"))
    demand = np.zeros(UNITS, np.int64)
    for r in items.groupBy("units").agg(F.count(F.lit(1)).alias("n")).collect():  # UNITS rows at most
        demand[r.units - 1] = r.n
    made = patterns(demand)
    ranked = running(items, ["units", "rest", "row"], {"rank": F.lit(1)}, "op13-ranked")
    laid = written(lay_out(ranked.drop("units"), made, demand), "op13-laid")
    totals = laid.groupBy("pattern").agg(F.sum("rest").alias("tokens")).collect()  # a row for each pattern
    kept = kept_sequences(made, {r.pattern: r.tokens for r in totals})

    before = Window.partitionBy("sequence").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    whole = laid.filter(F.col("sequence") < kept).select(
        "row",
        (F.col("blocks") * SEQUENCE).alias("start"),
        F.col("rest").alias("length"),
        F.col("sequence").alias("sequence_id"),
        F.coalesce(F.sum("rest").over(before), F.lit(0)).alias("offset"),
    )
    whole = written(whole, "op13-whole")
    fill = whole.groupBy("sequence_id").agg(F.sum("length").alias("fill")).filter(F.col("fill") < SEQUENCE)
    gaps = fill.select("sequence_id", "fill", (SEQUENCE - F.col("fill")).alias("length"))
    gaps = running(gaps, ["sequence_id"], {"at": F.col("length")}, "op13-gaps")
    free = laid.filter(F.col("sequence") >= kept).select(
        "row", (F.col("blocks") * SEQUENCE).alias("begin"), F.col("rest").alias("length"), "rank"
    )
    free = written(running(free, ["rank"], {"at": F.col("length")}, "op13-free"), "op13-fillers")

    def total(rows: DataFrame) -> int:
        return rows.agg(F.sum("length")).first()[0] or 0

    open_tokens = total(gaps)
    over = max(0, total(free) - open_tokens)
    own, tail = divmod(over, SEQUENCE)
    more = spark.range(own).select(
        (F.col("id") + kept).alias("sequence_id"),
        F.lit(0).cast("long").alias("fill"),
        F.lit(SEQUENCE).cast("long").alias("length"),
        (F.col("id") * SEQUENCE + open_tokens).alias("at"),
    )
    ends, at = [], open_tokens + own * SEQUENCE
    for power in reversed(range(SEQUENCE.bit_length())):
        if tail >> power & 1:
            ends.append((kept + own + len(ends), 0, 1 << power, at))
            at += 1 << power
    last = spark.createDataFrame(ends, "sequence_id long, fill long, length long, at long")
    cut = overlaid(gaps.unionByName(more).unionByName(last), free).select(
        "row",
        (F.col("begin") + F.col("low") - F.col("fill_at")).alias("start"),
        (F.col("high") - F.col("low")).alias("length"),
        "sequence_id",
        (F.col("fill") + F.col("low") - F.col("gap_at")).alias("offset"),
    )
    long = sized.filter("blocks > 0").select("row", "blocks")
    long = running(long, ["row"], {"first": F.col("blocks")}, "op13-long")
    block = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    blocks = long.select("row", "first", block.alias("nth")).select(
        "row",
        (F.col("nth") * SEQUENCE).alias("start"),
        F.lit(SEQUENCE).cast("long").alias("length"),
        (F.col("first") + F.col("nth") + kept + own + len(ends)).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
    )
    return whole.unionByName(cut).unionByName(blocks)


def pack_documents(documents: DataFrame, key: str, text: str, vocabulary: str, end_id: int = END_ID) -> DataFrame:
    """Pieces of all documents with their ids (little-endian unsigned 32-bit).

    Every document, an empty or null one too, is its ids and the end id. Rows with one key,
    equal rows and null keys are documents of their own; ``row`` tells them apart.
    """
    made = encode(documents, key, text, vocabulary, end_id).withColumn("row", F.monotonically_increasing_id())
    ids = written(made.withColumn("n_tokens", (F.octet_length("ids") / 4).cast("long")), "op13-ids")
    pieces = packed(ids.select("row", "n_tokens"))
    whole = ids.select("row", "doc_id", F.col("n_tokens").alias("doc_tokens"), F.col("ids").alias("all_ids"))
    found = F.substring("all_ids", F.col("start") * 4 + 1, F.col("length") * 4)
    return pieces.join(whole, "row").withColumn("ids", found).drop("all_ids")


def op13_packing(spark: SparkSession, sf_dir: str, vocabulary: str | None = None) -> DataFrame:
    """All documents in sequences of up to 4096 tokens, piece by piece."""
    path = vocabulary or public_tokenizers.path("word_bpe_49k.json")
    made = pack_documents(table(spark, sf_dir, "documents"), "doc_id", "text", path)
    return made.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )
