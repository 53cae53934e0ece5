"""Toxicity by maximum-scoring segments of token log-odds."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm.common import table
from tickloom.llm.words import Words, encoded, scan, slices
from tickloom.session import written

BUCKETS = 1 << 18  # tokens are counted by hash, so the model has this size whatever the vocabulary
PRIOR_WEIGHT = 200.0  # tokens that the background's prior counts as, in either class
FOLDS, HELD_OUT = 5, 0
FIT_ROWS = 200_000  # about so many labelled rows at most, picked by a hash, fit the model
_BINS = 512


@dataclass
class Model:
    """Scores by bucket of token, the laws of segments, and the calibration to 0 to 1."""

    scores: np.ndarray
    decay: float  # lambda and log K of the extreme-value law of a clean text's best segment
    log_k: float
    slope: float  # of the logistic law of a text's evidence
    offset: float


def buckets(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(46)).astype(np.int64)


def log_odds(toxic: np.ndarray, clean: np.ndarray) -> np.ndarray:
    """Token log-odds of the two classes under Dirichlet priors shaped like all tokens together.

    Each log-odds ratio is divided by its standard error where that is above 1, so that rare
    tokens weigh little, and drawn below zero on average as segment scores must be.
    """
    both = toxic + clean
    prior = PRIOR_WEIGHT * (both + 0.01) / (both + 0.01).sum()
    a, b = toxic + prior, clean + prior
    odds = np.log(a / (toxic.sum() + PRIOR_WEIGHT - a)) - np.log(b / (clean.sum() + PRIOR_WEIGHT - b))
    error = np.sqrt(1 / a + 1 / b)
    sure = odds * np.minimum(1, np.abs(odds) / (2 * error))
    return np.clip(sure, -2.0, 6.0) - 0.5


def positive_runs(scores: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Start, end, text and sum of the runs of tokens with positive scores."""
    up = scores > 0
    edge = np.flatnonzero(up[1:] != up[:-1]) + 1
    # a text's first token begins a new run
    edge = np.union1d(edge, offsets[1:-1])
    begin = np.concatenate([[0], edge[(edge > 0) & (edge < len(scores))]]).astype(np.int64)
    begin = begin[: len(begin) if len(scores) else 0]
    end = np.append(begin[1:], len(scores)) if len(begin) else begin
    keep = up[begin] if len(begin) else np.zeros(0, bool)
    begin, end = begin[keep], end[keep]
    total = np.concatenate([[0.0], np.cumsum(scores)])
    return begin, end, np.searchsorted(offsets, begin, side="right") - 1, total[end] - total[begin]


def maximal_segments(begin: list[int], end: list[int], low: list[float], high: list[float]) -> list[tuple[int, int, float]]:
    """All maximal scoring segments of one text, in time linear in its positive runs.

    ``low`` and ``high`` are the running totals before and after each run. A run joins the
    nearest earlier segment that begins lower if that also ends lower, and again. Every segment
    knows the nearest earlier one that begins lower than itself, so a search passes over those
    between; what it has passed lies behind the new segment's own link, or is joined to it,
    and is never passed again.
    """
    found: list[tuple[int, int, float, float, int]] = []
    for b, e, lo, hi in zip(begin, end, low, high, strict=True):
        j = len(found) - 1
        while True:
            while j >= 0 and found[j][2] >= lo:
                j = found[j][4]
            if j < 0 or found[j][3] >= hi:
                found.append((b, e, lo, hi, j))
                break
            b, _, lo, _, lower = found[j]
            del found[j:]
            j = lower
    return [(b, e, hi - lo) for b, e, lo, hi, _ in found]


def passages(scores: np.ndarray, offsets: np.ndarray) -> list[list[tuple[int, int, float]]]:
    """The maximal segments of each text: first token, token after the last, and score."""
    begin, end, owner, _ = positive_runs(scores, offsets)
    total = np.concatenate([[0.0], np.cumsum(scores)])
    cut = np.searchsorted(owner, np.arange(len(offsets)))
    b, e, low, high = begin.tolist(), end.tolist(), total[begin].tolist(), total[end].tolist()
    return [
        [
            (x - int(offsets[i]), y - int(offsets[i]), s)
            for x, y, s in maximal_segments(b[p:q], e[p:q], low[p:q], high[p:q])
        ]
        for i, (p, q) in enumerate(zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True))
    ]


def evidence(segments: list[tuple[int, int, float]], tokens: int, decay: float, log_k: float) -> float:
    """Minus the log of the chance that a clean text of as many tokens has such segments.

    A segment's score S stands for K * tokens * exp(-decay * S) expected ones by chance. Those
    that are expected less than once are significant; their evidence adds up.
    """
    base = log_k + math.log(max(tokens, 1))
    return sum(max(0.0, decay * s - base) for _, _, s in segments)


def token_scores(words: Words, scores: np.ndarray) -> np.ndarray:
    """Scores of tokens in their texts: the k-th of equal tokens of a text adds a k-th of a
    positive score, so that a text that repeats one word does not pass for a toxic one."""
    at = buckets(words.hash)
    values = scores[at].copy()
    up = np.flatnonzero(values > 0)
    owner = np.searchsorted(words.offsets, up, side="right") - 1
    key = owner * BUCKETS + at[up]
    order = np.argsort(key, kind="stable")
    ranked = key[order]
    new = np.ones(len(ranked), bool)
    new[1:] = ranked[1:] != ranked[:-1]
    place = np.arange(len(ranked))
    nth = place - np.maximum.accumulate(np.where(new, place, 0)) + 1 if len(ranked) else place
    values[up[order]] /= nth
    return values


def scored(batch: pd.Series, scores: np.ndarray) -> Iterator[tuple[list[list[tuple[int, int, float]]], np.ndarray]]:
    texts = encoded(batch)
    for begin, end in slices(texts):
        words = scan(texts[begin:end], lower=True, tails=True)
        yield passages(token_scores(words, scores), words.offsets), np.diff(words.offsets)


def token_counts(rows: DataFrame, text: str, toxic: str) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of the toxic and of the clean rows, by bucket; a text's equal tokens count once."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums = np.zeros((2, BUCKETS), np.int64)
        for frame in batches:
            label = frame[toxic].to_numpy().astype(np.int64)
            texts = encoded(frame[text])
            for begin, end in slices(texts):
                words = scan(texts[begin:end], lower=True, tails=True)
                owner = np.repeat(np.arange(begin, end), np.diff(words.offsets))
                once = np.unique(owner * BUCKETS + buckets(words.hash))
                pair = label[once // BUCKETS] * BUCKETS + once % BUCKETS
                sums += np.bincount(pair, minlength=2 * BUCKETS).reshape(2, -1)
        at = np.flatnonzero(sums.any(axis=0))
        yield pd.DataFrame({"bucket": at, "clean": sums[0, at], "toxic": sums[1, at]})

    sums = rows.select(text, toxic).mapInPandas(count, "bucket long, clean long, toxic long")
    found = sums.groupBy("bucket").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    made = np.zeros((2, BUCKETS))
    # at most BUCKETS rows
    for r in found.toLocalIterator():
        made[:, r.bucket] = r.clean, r.toxic
    return made[1], made[0]


def fit_law(rows: DataFrame, text: str, toxic: str, scores: np.ndarray) -> tuple[float, float]:
    """Decay and log K of the best segment of clean texts, by the moments of the extreme-value law.

    For a text of n tokens the best score, less log(n) / decay, has a law that does not depend
    on n. Sums over the clean rows give mean and variance, in two rounds as the shift needs
    the decay.
    """

    def best(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            for found, sizes in scored(frame[text], scores):
                top = [max((s for _, _, s in x), default=0.0) for x in found]
                yield pd.DataFrame({"top": top, "n": np.log(np.maximum(sizes, 1))})

    tops = rows.filter(F.col(toxic) == 0).select(text).mapInPandas(best, "top double, n double")
    m = tops.agg(
        F.avg("top").alias("t"),
        F.avg("n").alias("n"),
        F.var_pop("top").alias("tt"),
        F.var_pop("n").alias("nn"),
        F.covar_pop("top", "n").alias("tn"),
    ).first()
    if m.t is None or not m.tt:
        return 1.0, 0.0
    decay = 1.0
    for _ in range(50):  # var(top - n / decay) = pi^2 / (6 decay^2)
        spread_ = max(m.tt - 2 * m.tn / decay + m.nn / decay**2, 1e-6)
        decay = min(max(0.5 * decay + 0.5 * math.pi / math.sqrt(6 * spread_), 0.2), 5.0)
    mean = m.t - m.n / decay
    return decay, decay * mean - 0.5772156649


def fit_calibration(rows: DataFrame, text: str, toxic: str, scores: np.ndarray, law: tuple[float, float]) -> tuple[float, float]:
    """Logistic regression of the label on log(1 + evidence), from counts in fixed bins."""

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            values = [
                evidence(x, int(n), *law)
                for found, sizes in scored(frame[text], scores)
                for x, n in zip(found, sizes, strict=True)
            ]
            at = np.minimum((np.log1p(values) * 64).astype(np.int64), _BINS - 1) if values else []
            yield pd.DataFrame({"bin": np.asarray(at, np.int64), "toxic": frame[toxic].to_numpy()})

    counts = (
        rows.select(text, toxic)
        .mapInPandas(measure, "bin long, toxic long")
        .groupBy("bin")
        .agg(F.sum("toxic").alias("toxic"), F.count(F.lit(1)).alias("n"))
        .collect()
    )
    x = np.array([(r.bin + 0.5) / 64 for r in counts])
    y = np.array([float(r.toxic) for r in counts])
    n = np.array([float(r.n) for r in counts])
    slope, offset = 1.0, -1.0
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(slope * x + offset, -30, 30)))
        w = n * p * (1 - p) + 1e-9
        design = np.array([[np.sum(w * x * x) + 1, np.sum(w * x)], [np.sum(w * x), np.sum(w) + 1e-3]])
        off = np.array([np.sum((y - n * p) * x) - (slope - 1.0), np.sum(y - n * p)])
        step = np.clip(np.linalg.solve(design, off), -1, 1)
        slope, offset = slope + step[0], offset + step[1]
        if np.abs(step).max() < 1e-8:
            break
    return float(slope), float(offset)


def remainder(doc_id: Column) -> Column:
    """The fold of a document: CRC-32 of its id as text, modulo FOLDS."""
    return F.crc32(doc_id.cast("string").cast("binary")) % FOLDS


def fit(documents: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> Model:
    """Fits a model on labelled documents (``doc_id``, ``text``; ``doc_id``, ``toxic``).

    Labels of the held-out fold and null labels are not read. If there are more than
    ``fit_rows`` labelled rows, about so many are used, picked by a hash of ``doc_id``: the
    bound is a parameter and the sample does not depend on order. Contradicting labels of a document
    all count. Without labels of both kinds the model says 0 for every text.
    """
    known = labels.select("doc_id", F.col("toxic").cast("long").alias("_toxic")).filter(
        F.col("_toxic").isin(0, 1) & (remainder(F.col("doc_id")) != HELD_OUT)
    )
    count = known.count()
    if count > fit_rows:
        known = known.filter(F.pmod(F.xxhash64("doc_id"), F.lit(count)) < fit_rows)
    # about fit_rows pairs of integers at most
    rows = documents.select("doc_id", "text").join(F.broadcast(known), "doc_id").drop("doc_id")
    rows = written(rows, "op6-labelled")
    toxic, clean = token_counts(rows, "text", "_toxic")
    if not toxic.any() or not clean.any():
        return Model(np.full(BUCKETS, -0.5), 1.0, 0.0, 1.0, -30.0)
    scores = log_odds(toxic, clean)
    law = fit_law(rows, "text", "_toxic", scores)
    return Model(scores, *law, *fit_calibration(rows, "text", "_toxic", scores, law))


def score(text: Column, model: Model, spark: SparkSession) -> Column:
    """A toxicity of 0 to 1 for a text column; null counts as empty."""
    sent = spark.sparkContext.broadcast(model)  # BUCKETS numbers

    @F.pandas_udf("double")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        m = sent.value
        for batch in batches:
            values = [
                evidence(x, int(n), m.decay, m.log_k)
                for found, sizes in scored(batch, m.scores)
                for x, n in zip(found, sizes, strict=True)
            ]
            x = np.clip(m.slope * np.log1p(np.array(values, float)) + m.offset, -30, 30)
            yield pd.Series(1 / (1 + np.exp(-x)))

    return of(text)


def toxic_passages(documents: DataFrame, model: Model, key: str, text: str) -> DataFrame:
    """Every significant toxic passage: the key, its first and last word, and its evidence."""
    sent = documents.sparkSession.sparkContext.broadcast(model)
    schema = documents.select(key).schema.simpleString()[7:-1]

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = sent.value
        for frame in batches:
            keys, rows = frame[key].tolist(), []
            for found, sizes in scored(frame[text], m.scores):
                for x, n in zip(found, sizes, strict=True):
                    own, keys = keys[0], keys[1:]
                    for a, b, s in x:
                        if (e := evidence([(a, b, s)], int(n), m.decay, m.log_k)) > 0:
                            rows.append((own, a, b, e))
            yield pd.DataFrame(rows, columns=[key, "first_word", "after_word", "evidence"])

    return documents.select(key, text).mapInPandas(
        work, f"{schema}, first_word long, after_word long, evidence double"
    )


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents; the fold of remainder 0 is never learnt from."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(documents, table(spark, sf_dir, "labels"))
    value = documents.withColumn("score", score(F.col("text"), model, spark))
    return value.select(
        "doc_id",
        (remainder(F.col("doc_id")) == HELD_OUT).alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).cast("int").alias("predicted"),
    )
