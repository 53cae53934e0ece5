"""Document fingerprints: digests of improbable byte windows in chained Bloom filters."""

from __future__ import annotations

import base64
import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm.common import table
from tickloom.llm.words import mixed
from tickloom.session import written

WINDOW = 64  # bytes of a feature, and features that compete for the lowest rank
POPULAR = 16  # times a feature must win to be kept
SHORT = 2 * WINDOW + POPULAR - 2  # bytes below which no window can win so often
SHORT_WINDOW, SHORT_POPULAR = 8, 2  # the same of texts below that
FILTER_BITS = 2048
FILTER_FEATURES = 160
HASHES = 5
SLICE_BYTES = 1 << 20
BLOCK_BYTES = 2 << 20
MOST_BLOCKS = 1 << 16  # beyond it blocks grow; their rows are sorted and read as a stream

# Rarity by entropy: how unlikely a window of the given entropy is under a normal law around
# the usual entropy of prose. The lowest rank is the rarest; windows that are near constant
# (padding, rules of one mark) rank last, as they say nothing about a document.
_SCALE = 1 << 14
_COUNTS = np.arange(WINDOW + 1)
_TERM = np.rint(_SCALE * np.where(_COUNTS > 0, _COUNTS * np.log2(np.maximum(_COUNTS, 1)), 0)).astype(np.int64)
_LEAST = 1.0
_LAWS = {WINDOW: (3.6, 0.3), SHORT_WINDOW: (2.7, 0.25)}  # usual entropy and spread by window


def entropies(data: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Bits of entropy of every window of so many bytes.

    The number of equal bytes before and behind each byte within a window gives what it adds
    when it enters and takes away when it leaves; running sums of that give all windows.
    """
    n = len(data)
    before, after = np.zeros(n, np.uint8), np.zeros(n, np.uint8)
    for k in range(1, window):
        same = (data[k:] == data[:-k]).view(np.uint8)
        before[k:] += same
        after[:-k] += same
    enter = (_TERM[1:] - _TERM[:-1])[before]
    leave = (_TERM[1:] - _TERM[:-1])[after]
    # of a window, the sum over its bytes' values of count * log2(count)
    total = np.cumsum(enter)
    gone = np.cumsum(leave)
    held = total[window - 1 :].copy()
    held[1:] -= gone[: n - window]
    return np.log2(window) - held / (_SCALE * window)


def ranks(entropy: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Rarity ranks, 0 the rarest, of which ties are settled by place."""
    usual, spread = _LAWS[window]
    off = np.minimum(np.abs(entropy - usual) / spread, 8.0)
    return np.where(entropy < _LEAST, 1 << 16, np.rint((8.0 - off) * 1000)).astype(np.int64)


def features(
    data: np.ndarray, owner_end: np.ndarray, window: int = WINDOW, popular: int = POPULAR
) -> tuple[np.ndarray, np.ndarray]:
    """Starts and hashes of the kept windows of texts that lie end to end.

    ``owner_end`` is, for each byte, the end of its text. Races run over ``window`` neighbouring
    windows of one text; the one of lowest rank, the leftmost among equals, wins, and those
    that win ``popular`` races are kept. So a text of fewer than 2 * window + popular - 2 bytes
    has none.
    """
    n = len(data) - window + 1
    if n < window:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    at = np.arange(n)
    inside = at + window <= owner_end[:n]
    rank = ranks(entropies(data, window), window)
    packed = np.where(inside, (rank << 40) + at, np.int64(1) << 62)
    best, span = packed, 1
    while span < window:
        step = min(span, window - span)
        best = np.minimum(best[: len(best) - step], best[step:])
        span += step
    first = np.arange(len(best))
    races = first + 2 * window - 1 <= owner_end[: len(best)]
    wins = np.bincount(best[races] & ((1 << 40) - 1), minlength=n)
    keep = inside & (wins >= popular) & (rank < 1 << 16)
    start = np.flatnonzero(keep)
    grid = data[start[:, None] + np.arange(window)]
    lanes = np.ascontiguousarray(grid).view("<u8")
    hashed = np.zeros(len(start), np.uint64)
    for lane in lanes.T:
        hashed = mixed(hashed ^ lane)
    return start, hashed


def filters(hashes: np.ndarray) -> np.ndarray:
    """Chained Bloom filters: a new one is begun after FILTER_FEATURES features."""
    count = -(-len(hashes) // FILTER_FEATURES)
    bits = np.zeros((count, FILTER_BITS), bool)
    which = np.arange(len(hashes)) // FILTER_FEATURES
    for k in range(HASHES):
        bits[which, (hashes >> np.uint64(11 * k)) % FILTER_BITS] = True
    return np.packbits(bits, axis=1)


def digest(hashes: np.ndarray, raw: bytes) -> tuple[str, np.ndarray]:
    """The fingerprint as text and as filters.

    A text without a kept window (it is very short, or near constant) is known by its SHA-256 only.
    """
    if not len(hashes):
        return f"0:{hashlib.sha256(raw).hexdigest()}", np.zeros((0, FILTER_BITS // 8), np.uint8)
    made = filters(hashes)
    return f"{len(hashes)}:{base64.b64encode(made.tobytes()).decode()}", made


def likeness(a: tuple[str, np.ndarray], b: tuple[str, np.ndarray]) -> float:
    """Bit overlap beyond what chance gives, 0 to 1, averaged over the filters of the shorter.

    For every filter the best overlap with a filter of the other counts, scaled so that the
    overlap expected of unrelated filters is 0 and the largest possible is 1.
    """
    if a[0] == b[0]:
        return 1.0
    if len(a[1]) == len(b[1]):
        return (_likeness(a[1], b[1]) + _likeness(b[1], a[1])) / 2
    return _likeness(*sorted((a[1], b[1]), key=len))


def _likeness(x: np.ndarray, y: np.ndarray) -> float:
    if not len(x):
        return 0.0
    ones_x = np.bitwise_count(x).sum(axis=1, dtype=np.int64)
    ones_y = np.bitwise_count(y).sum(axis=1, dtype=np.int64)
    best = np.zeros(len(x))
    for i in range(len(x)):
        both = np.bitwise_count(x[i] & y).sum(axis=1, dtype=np.int64)
        most = np.minimum(ones_x[i], ones_y)
        chance = ones_x[i] * ones_y / FILTER_BITS
        slack = chance + 0.3 * (most - chance)
        best[i] = np.max(np.clip((both - slack) / np.maximum(most - slack, 1e-9), 0, 1))
    return float(np.average(best, weights=ones_x))


def digests(texts: list[bytes]) -> list[tuple[str, np.ndarray]]:
    """Fingerprints of many texts, worked on together in slices of bounded size.

    Texts under SHORT bytes have features of SHORT_WINDOW bytes, those under 16 bytes none.
    Features of both kinds are never alike, so neither are a short text and a long one.
    """
    out, begin = [], 0
    while begin < len(texts):
        end, total = begin, 0
        while end < len(texts) and (end == begin or total + len(texts[end]) <= SLICE_BYTES):
            total += len(texts[end])
            end += 1
        part = texts[begin:end]
        hashes = hashes_of(part, WINDOW, POPULAR)
        short = [i for i, t in enumerate(part) if len(t) < SHORT]
        for i, found in zip(short, hashes_of([part[i] for i in short], SHORT_WINDOW, SHORT_POPULAR), strict=True):
            hashes[i] = found
        out += [digest(h, t) for h, t in zip(hashes, part, strict=True)]
        begin = end
    return out


def hashes_of(texts: list[bytes], window: int, popular: int) -> list[np.ndarray]:
    """The features of each text."""
    if not texts:
        return []
    sizes = [len(t) for t in texts]
    ends = np.cumsum(sizes)
    start, hashed = features(np.frombuffer(b"".join(texts), np.uint8), np.repeat(ends, sizes), window, popular)
    return np.split(hashed, np.searchsorted(start, ends)[:-1])


def edited(text: str, after: str) -> str:
    """The last third of a text replaced by as many characters (or all) from the next one."""
    third = len(text) // 3
    return text[: len(text) - third] + after[:third]


_SCHEMA = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
    "edited_fingerprint string, near_edited double, near_next double"
)


def fingerprint_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows of blocks in order: each block's documents, then, marked ``extra``, the next block's first."""
    last: tuple | None = None  # block, doc_id, text and fingerprint of the row before

    def pieces(frame: pd.DataFrame) -> Iterator[pd.DataFrame]:
        sizes = frame["text"].str.len().to_numpy()
        begin = 0
        while begin < len(frame):
            end = begin + max(1, int(np.searchsorted(np.cumsum(sizes[begin:]), SLICE_BYTES)))
            yield frame.iloc[begin:end]
            begin = end

    for batch in batches:
        for frame in pieces(batch):
            texts = frame["text"].tolist()
            prints = digests([t.encode() for t in texts])
            rows = list(zip(frame["block"].tolist(), frame["doc_id"].tolist(), texts, prints, frame["extra"].tolist()))
            before = [last, *rows[:-1]]
            last = rows[-1]
            pairs = [
                (a, b) for a, b in zip(before, rows) if a is not None and a[0] == b[0] and not a[4]
            ]
            changed = [edited(a[2], b[2]) for a, b in pairs]
            made = digests([t.encode() for t in changed])
            out = [
                (
                    a[1],
                    len(a[2]),
                    hashlib.sha256(text.encode()).hexdigest(),
                    a[3][0],
                    new[0],
                    likeness(a[3], new),
                    likeness(a[3], b[3]),
                )
                for (a, b), text, new in zip(pairs, changed, made, strict=True)
            ]
            frame = pd.DataFrame(out, columns=[c.split()[0] for c in _SCHEMA.split(", ")])
            yield frame.astype({"doc_id": "Int64"})


def fingerprint_documents(documents: DataFrame, key: str, text: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Fingerprints of texts and of their edited texts, in descending order of an integer key.

    Null texts count as empty, null keys come last, and equal keys are ordered by their
    texts. The next document after the last is the first; a single document is its own next.

    The key's range is cut at quantiles into blocks of about ``block_bytes`` of text. A block
    is sorted in one task, and the first row of every block, one for each block, is also sent
    to the end of the block before it. The texts are shuffled once.
    """
    spark = documents.sparkSession
    slim = written(documents.select(F.col(key).cast("long").alias("doc_id"), F.length(text).alias("n")), "op7-keys")
    known = slim.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("chars"), F.count("doc_id").alias("keys")).first()
    blocks = min(MOST_BLOCKS, max(1, -(-known.chars // block_bytes)))
    cuts: list[float] = []
    if known.keys and blocks > 1:
        points = [i / blocks for i in range(1, blocks)]
        found = slim.agg(F.percentile_approx("doc_id", points, 100 * blocks)).first()[0]
        cuts = sorted({float(x) for x in found})
    # one row for each block
    heads = sorted(
        (tuple(r) for r in in_blocks(slim, cuts).groupBy("block").agg(F.max("doc_id")).collect()),
        reverse=True,
    )
    before = [(heads[i][1], heads[i - 1][0]) for i in range(len(heads))]
    first = spark.createDataFrame(before, "head long, extra_block long")
    rows = documents.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    placed = in_blocks(rows, cuts).join(
        F.broadcast(first), F.col("doc_id").eqNullSafe(F.col("head")), "left"
    )
    own = F.struct(F.col("block").alias("block"), F.lit(False).alias("extra"))
    also = F.struct(F.col("extra_block").alias("block"), F.lit(True).alias("extra"))
    sent = F.when(F.col("extra_block").isNull(), F.array(own)).otherwise(F.array(own, also))
    return (
        placed.select("doc_id", "text", F.explode(sent).alias("to"))
        .select("doc_id", "text", "to.block", "to.extra")
        .repartition("block")
        .sortWithinPartitions(F.desc("block"), "extra", F.desc_nulls_last("doc_id"), "text")
        .mapInPandas(fingerprint_rows, _SCHEMA)
    )


def in_blocks(frame: DataFrame, cuts: list[float]) -> DataFrame:
    """Adds ``block``, the number of cuts at or below ``doc_id``; -1 for a null key."""
    if not cuts:
        return frame.withColumn("block", F.when(F.col("doc_id").isNull(), -1).otherwise(0).cast("long"))
    splits = [-math.inf, *cuts, math.inf]
    found = Bucketizer(splits=splits, inputCol="_key", outputCol="_block").transform(
        frame.withColumn("_key", F.coalesce("doc_id", F.lit(0)).cast("double"))
    )
    block = F.when(F.col("doc_id").isNull(), -1).otherwise(F.col("_block")).cast("long")
    return found.withColumn("block", block).drop("_key", "_block")


def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents, of their edited texts, and their likenesses."""
    return fingerprint_documents(table(spark, sf_dir, "documents"), "doc_id", "text")
