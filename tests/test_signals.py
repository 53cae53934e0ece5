"""Cross signals against a plain loop over each series."""

from __future__ import annotations

import random

import pytest

from tests.data import at, rows_of
from tickloom.operators import signals
from tickloom.operators.hotkeys import DEFAULT_POLICY, SplitPolicy

FEE, CAPITAL = 10.0, 1000.0


def walk(series):
    """One account, one row after another."""
    keep = 1 - FEE / 10_000
    cash, held, bought, trades, acts = CAPITAL, 0.0, None, [], []
    for time, price, sma, ema in series:
        if not price or sma is None or ema is None or sma == ema:
            continue
        if ema > sma and bought is None:
            held, cash, bought = cash / price * keep, 0.0, price
            acts.append((time, "BUY", price, held))
        elif ema < sma and bought is not None:
            cash = held * price * keep
            trades.append((bought, price))
            acts.append((time, "SELL", price, None))
            held, bought = 0.0, None
    time, price = series[-1][:2]
    if bought is not None and price:
        cash = held * price * keep
        trades.append((bought, price))
        acts.append((time, "SELL_EOD", price, None))
    return (cash if cash > 0 else CAPITAL), trades, acts


def _series(rng, length):
    level = rng.choice([1e-6, 1.0, 4e4])
    return [
        (
            at(i),
            0.0 if rng.random() < 0.05 else level * rng.uniform(0.5, 2),
            None if rng.random() < 0.1 else level * rng.choice([1, 2, 3]),
            None if rng.random() < 0.1 else level * rng.choice([1, 2, 3]),
        )
        for i in range(length)
    ]


@pytest.mark.parametrize("policy", [DEFAULT_POLICY, SplitPolicy(15, 4), SplitPolicy(15, 4, broadcast_rows=0)])
def test_equals_a_loop(spark, policy):
    rng = random.Random(11)
    every = {f"k{i:02}": _series(rng, rng.choice([1, 19, 20, 25, 60])) for i in range(40)}
    rows = [(key, *row) for key, series in every.items() for row in series]
    rng.shuffle(rows)
    metrics = spark.createDataFrame(
        rows, "id string, timestamp timestamp_ntz, price double, sma double, ema double"
    )
    run = signals.cross_run(metrics, policy=policy)
    results = {r.coin_id: r for r in signals.cross_backtest(run, 60, CAPITAL, FEE).collect()}
    trades, actions = {}, {}
    for r in signals.cross_trades(run).orderBy("id", "exit_time", "exit_action").collect():
        trades.setdefault(r.id, []).append((r.entry_price, r.exit_price))
    got = signals.cross_actions(run, CAPITAL, FEE).collect()
    rank = {"BUY": 0, "SELL": 1, "SELL_EOD": 2}
    for r in sorted(got, key=lambda r: (r.id, r.time, rank[r.action])):
        actions.setdefault(r.id, []).append((r.time, r.action, r.price, r.qty))

    assert set(results) == set(every)
    for key, series in every.items():
        result = results[key]
        assert result.points == len(series)
        if len(series) < signals.MIN_POINTS:
            assert result.error == signals.TOO_SHORT
            assert result.final_equity is None
            assert key not in trades and key not in actions
            continue
        equity, sold, acts = walk(series)
        assert result.error is None
        assert result.final_equity == pytest.approx(equity, abs=0.0051)
        assert result.trades == len(sold)
        wins = sum(round((out - into) / into * 100, 4) > 0 for into, out in sold)
        if sold:
            assert result.win_rate_pct == pytest.approx(wins / len(sold) * 100, abs=0.0051)
        else:
            assert result.win_rate_pct is None
        assert trades.get(key, []) == sold
        kept = acts[-signals.KEPT_ACTIONS :]
        mine = actions.get(key, [])
        assert [a[:3] for a in mine] == [a[:3] for a in kept]
        for a, b in zip(mine, kept):
            assert a[3] is None if b[3] is None else a[3] == pytest.approx(b[3], rel=1e-9)


def test_unsold_position_reports_the_initial_capital(spark):
    series = [(at(i), 10.0, 1.0, 2.0) for i in range(25)] + [(at(25), 0.0, 1.0, 2.0)]
    metrics = spark.createDataFrame(
        [("a", *row) for row in series],
        "id string, timestamp timestamp_ntz, price double, sma double, ema double",
    )
    run = signals.cross_run(metrics)
    result = signals.cross_backtest(run, 60).first()
    assert (result.final_equity, result.trades, result.buy_hold_return_pct) == (1000.0, 0, None)
    assert [row[1] for row in rows_of(signals.cross_actions(run), "id", "action")] == ["BUY"]
