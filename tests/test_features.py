from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tests.data import at, rows_of, ticks
from tickloom.operators.features import features, latest_features
from tickloom.operators.hotkeys import (
    SplitPolicy,
    hot_keys,
    running_max,
    time_cuts,
    with_slices,
)
from tickloom.operators.risk import drawdown

ORDER = ("timestamp", "seq")


def test_hand_worked_series(spark):
    out = features(ticks(spark, [100.0, 102.0, 101.0, 105.0, 110.0, 120.0])).orderBy("timestamp")
    got = rows_of(out, "change_1min", "change_5min", "sma", "ema", "volatility")
    expected = [
        (None, None, 100, 100, None),
        (2, None, 101, 101, 1.4142),
        (-0.98, None, 101, 101, 1),
        (3.96, None, 102, 102.6667, 2.1602),
        (4.76, None, 103.6, 105.3333, 4.0373),
        (9.09, 20, 107.6, 111.6667, 7.7653),
    ]
    for row, want in zip(got, expected):
        assert row == pytest.approx(want, abs=1e-4) if None not in want else True
        assert [x is None for x in row] == [x is None for x in want]
        for x, y in zip(row, want):
            assert y is None or x == pytest.approx(y, abs=1e-4)


def test_zero_previous_price_gives_null(spark):
    out = features(ticks(spark, [0.0, 5.0])).orderBy("timestamp")
    assert rows_of(out, "change_1min") == [(None,), (None,)]


def _skewed(spark, seed, n):
    """One key with most rows, bursts, gaps and equal times; several small keys."""
    rng = random.Random(seed)
    rows, minute = [], 0.0
    for seq in range(n):
        minute += rng.choice([0, 0, 0.01, 0.5, 1, 400])
        key = "hot" if rng.random() < 0.7 else rng.choice("abcdef")
        price = float(rng.choice([0, 1, 2, 3, 10, 50]))
        rows.append((at(minute), key, key, price, seq))
    rng.shuffle(rows)
    return spark.createDataFrame(
        rows, "timestamp timestamp_ntz, id string, symbol string, price double, seq long"
    )


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize(
    "policy", [SplitPolicy(3, 1), SplitPolicy(20, 7), SplitPolicy(10**6, 7)]
)
def test_slices_equal_whole_keys(spark, seed, policy):
    rows = _skewed(spark, seed, 300).cache()
    plain = sorted(map(repr, rows_of(features(rows, ORDER))))
    cut = sorted(map(repr, rows_of(features(rows, ORDER, policy))))
    assert plain == cut
    assert rows_of(drawdown(rows, ORDER).orderBy("id")) == rows_of(
        drawdown(rows, ORDER, policy).orderBy("id")
    )


def test_every_key_above_the_bound_is_hot(spark):
    rows = _skewed(spark, 3, 200)
    hot = hot_keys(rows, policy=SplitPolicy(hot_rows=60, slice_rows=5)).collect()
    count = rows.filter("id = 'hot'").count()
    assert [(r.id, r._pieces) for r in hot] == [("hot", -(-count // 5))]
    assert hot_keys(rows, policy=SplitPolicy(hot_rows=1, slice_rows=5)).count() == 7


def test_a_burst_is_cut_as_finely_as_its_rows_need(spark):
    """Nearly all ticks fall in one minute of a year."""
    rows = [(at(0), "a", 1.0), (at(525_600), "a", 1.0)]
    rows += [(at(1000 + i / 2000), "a", 1.0) for i in range(2000)]
    ticks = spark.createDataFrame(rows, "timestamp timestamp_ntz, id string, price double")
    policy = SplitPolicy(hot_rows=10, slice_rows=100)
    sliced = with_slices(ticks, ["id"], "timestamp", time_cuts(ticks, policy=policy))
    sizes = [r["count"] for r in sliced.groupBy("_slice").count().collect()]
    assert len(sizes) >= 20 and max(sizes) <= 150


def test_slices_follow_the_cuts(spark):
    cuts = spark.createDataFrame([("a", [60_000_000, 120_000_000])], "id string, _cuts array<long>")
    rows = [(key, datetime(1970, 1, 1) + timedelta(seconds=s)) for key, s in
            (("a", 0), ("a", 59.999999), ("a", 60), ("a", 119), ("a", 120), ("a", 500), ("b", 60))]
    rows.append(("a", None))
    frame = spark.createDataFrame(rows, "id string, timestamp timestamp_ntz")
    got = {(r.id, r.timestamp): r._slice for r in with_slices(frame, ["id"], "timestamp", cuts).collect()}
    assert [got[row] for row in rows] == [0, 0, 1, 1, 2, 2, None, 0]


def test_running_max_over_slices(spark):
    rows = _skewed(spark, 4, 200)
    cut = running_max(rows, ORDER, "price", "peak", policy=SplitPolicy(10, 3))
    plain = running_max(rows, ORDER, "price", "peak")
    assert sorted(map(repr, rows_of(cut))) == sorted(map(repr, rows_of(plain)))


def test_rows_without_a_key_are_cut_too(spark):
    rows = _skewed(spark, 8, 200).withColumn("id", F.when(F.col("id") != "hot", F.col("id")))
    hot = hot_keys(rows, policy=SplitPolicy(20, 5)).collect()
    assert [r.id for r in hot] == [None]
    plain = sorted(map(repr, rows_of(features(rows, ORDER))))
    assert sorted(map(repr, rows_of(features(rows, ORDER, SplitPolicy(20, 5))))) == plain
    cut = running_max(rows, ORDER, "price", "peak", policy=SplitPolicy(20, 5))
    whole = running_max(rows, ORDER, "price", "peak")
    assert sorted(map(repr, rows_of(cut))) == sorted(map(repr, rows_of(whole)))


def test_rows_without_time_stay(spark):
    rows = _skewed(spark, 5, 100).withColumn(
        "timestamp", F.when(F.col("seq") > 10, F.col("timestamp"))
    )
    plain = sorted(map(repr, rows_of(features(rows, ORDER))))
    assert sorted(map(repr, rows_of(features(rows, ORDER, SplitPolicy(5, 3))))) == plain


def test_latest_features_equal_last_rows(spark):
    rows = _skewed(spark, 6, 300)
    every = features(rows, ORDER)
    last = every.groupBy("id").agg(F.max(F.struct(*ORDER)).alias("m"))
    expected = every.join(last, "id").filter(
        (F.col("timestamp") == F.col("m.timestamp")) & (F.col("seq") == F.col("m.seq"))
    )
    got = latest_features(rows, ORDER)
    assert sorted(map(repr, rows_of(got))) == sorted(
        map(repr, rows_of(expected.select(*got.columns)))
    )


def test_partitioning_does_not_matter(spark):
    rows = _skewed(spark, 7, 200)
    one = sorted(map(repr, rows_of(features(rows.repartition(1), ORDER, SplitPolicy(9, 4)))))
    many = sorted(map(repr, rows_of(features(rows.repartition(13), ORDER, SplitPolicy(9, 4)))))
    assert one == many
