from __future__ import annotations

import itertools
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tests.data import START, at, rows_of, ticks
from tickloom import schemas
from tickloom.functions.clock import recent
from tickloom.functions.text import split_keys
from tickloom.operators import alerts, anomalies, candles, compare, quality, ranking, risk, runs
from tickloom.operators.hotkeys import SplitPolicy
from tickloom.plans import served

METRICS = "timestamp timestamp_ntz, id string, symbol string, price double, change_1min double, change_5min double, sma double, ema double, volatility double"


def metrics(spark, rows):
    full = [(t, k, k.upper(), p, None, c, 1.0, 1.0, v) for t, k, p, c, v in rows]
    return spark.createDataFrame(full, METRICS)


def test_candle_ends_follow_time_not_input_order(spark):
    rows = ticks(spark, [5.0, 9.0, 1.0, 4.0]).orderBy(F.desc("seq"))
    out = candles.candles(rows, timedelta(minutes=4))
    assert rows_of(out, "timestamp", "open", "high", "low", "close") == [(START, 5.0, 9.0, 1.0, 4.0)]


def test_open_bucket_gives_no_candle(spark):
    rows = ticks(spark, [1.0, 2.0, 3.0])
    out = candles.candles(rows, as_of=at(2.5)).orderBy("timestamp")
    # bucket 1 starts 90 s before the clock; bucket 2 is still open
    assert [r.timestamp for r in out.collect()] == [at(0), at(1)]
    assert candles.candles(rows, as_of=at(2)).count() == 1


def test_recent_candles_start_on_a_bucket_edge(spark):
    rows = spark.createDataFrame(
        [(at(0.1), "a", "A", 1.0), (at(0.9), "a", "A", 2.0), (at(1.5), "a", "A", 3.0)],
        "timestamp timestamp_ntz, id string, symbol string, price double",
    )
    # the look-back starts at 0.5, inside the first bucket
    out = candles.recent_candles(rows, at(10.5), 10).orderBy("timestamp")
    assert rows_of(out, "open", "close") == [(1.0, 2.0), (3.0, 3.0)]


@pytest.mark.parametrize(
    "change, kind", [(2.0, "PUMP"), (-2.0, "DUMP"), (1.99, None), (-1.99, None), (None, None)]
)
def test_alert_ends_are_included(spark, change, kind):
    out = alerts.price_alerts(metrics(spark, [(at(0), "a", 1.0, change, None)]), at(1), 2.0)
    assert [r.alert_type for r in out.collect()] == ([kind] if kind else [])
    assert out.columns == schemas.ALERTS.fieldNames()


def test_snapshot_drops_a_key_whose_latest_change_is_unknown_but_movers_do_not(spark):
    rows = metrics(spark, [(at(0), "a", 1.0, 5.0, None), (at(1), "a", 1.0, None, None)])
    assert ranking.top_gainers(ranking.latest_per_key(rows)).count() == 0
    assert rows_of(served.movers(rows, at(2))["gainers"], "id", "change_5min") == [("a", 5.0)]


def test_ranking_breaks_ties_by_key(spark):
    rows = metrics(spark, [(at(0), k, 1.0, 3.0, None) for k in "dbca"])
    out = ranking.top_losers(rows, 3).orderBy("rank")
    assert rows_of(out, "rank", "id") == [(1, "a"), (2, "b"), (3, "c")]


def test_recent_includes_its_lower_end(spark):
    rows = ticks(spark, [1.0, 2.0, 3.0])
    assert recent(rows, at(11), 10).count() == 2
    assert recent(rows, at(13), 10).isEmpty()


def test_equal_changes_are_no_anomaly(spark):
    rows = metrics(spark, [(at(i), "a", 1.0, 4.0, None) for i in range(5)])
    assert anomalies.anomalous(rows, 0.0).count() == 0


def test_spread_join_keeps_every_row(spark):
    rng = random.Random(5)
    rows = metrics(
        spark,
        [
            (at(i), "hot" if i % 4 else rng.choice("ab"), 1.0, rng.gauss(0, 1), None)
            for i in range(400)
        ],
    )
    plain = sorted(map(repr, rows_of(anomalies.z_scores(rows))))
    assert len(plain) == 400
    for short in (0, 100):
        policy = SplitPolicy(50, 20, broadcast_rows=short)
        assert sorted(map(repr, rows_of(anomalies.z_scores(rows, policy)))) == plain


def test_pair_correlations_against_loops(spark):
    rng = random.Random(9)
    series = {
        key: {m: rng.uniform(1, 9) for m in range(30) if rng.random() < 0.7} for key in "abcd"
    }
    rows = metrics(
        spark, [(at(m), k, p, None, None) for k, s in series.items() for m, p in s.items()]
    )
    got = {
        (r.id_a, r.id_b): (r.corr, r.overlap_points)
        for r in compare.pair_correlations(rows, "abcd").collect()
    }
    for a, b in itertools.combinations("abcd", 2):
        both = sorted(set(series[a]) & set(series[b]))
        x, y = [series[a][m] for m in both], [series[b][m] for m in both]
        mx, my = sum(x) / len(x), sum(y) / len(y)
        corr = sum((p - mx) * (q - my) for p, q in zip(x, y)) / (
            sum((p - mx) ** 2 for p in x) * sum((q - my) ** 2 for q in y)
        ) ** 0.5
        assert got[a, b] == (pytest.approx(corr, abs=6e-5), len(both))
    most = max(got.values(), key=lambda pair: pair[1])[1]
    assert compare.top_pair(rows, "abcd").first().overlap_points == most


def test_many_keys_do_not_make_a_large_plan(spark):
    rows = metrics(spark, [(at(0), f"k{i}", 1.0, None, None) for i in range(3)])
    plans = [
        compare.top_pair(rows, [f"k{i}" for i in range(n)])._jdf.queryExecution().executedPlan()
        for n in (3, 300)
    ]
    assert plans[1].toString().count("\n") == plans[0].toString().count("\n")


def test_pairs_without_common_times_are_absent(spark):
    rows = metrics(spark, [(at(0), "a", 1.0, None, None), (at(1), "b", 1.0, None, None)])
    assert compare.pair_correlations(rows, ["a", "b"]).count() == 0


def test_comparison_needs_two_keys():
    assert split_keys(" A, b ,,") == ["a", "b"]
    with pytest.raises(ValueError):
        split_keys("a, ")


def test_compare_gives_three_parts(spark):
    rows = metrics(spark, [(at(i), k, 1.0 + i, None, None) for i in range(3) for k in "abc"])
    parts = served.compare(rows, "A, b", at(5))
    assert [r.id for r in parts["latest"].collect()] == ["a", "b"]
    assert rows_of(parts["window_stats"], "id", "net_change_pct") == [("a", 200.0), ("b", 200.0)]
    assert rows_of(parts["top_pair_correlation"]) == [("a", "b", 1.0, 3)]


def test_summary_of_an_unknown_key_has_zero_points(spark):
    rows = metrics(spark, [(at(0), "a", 0.0, None, None), (at(1), "a", 2.0, None, None)])
    assert served.coin_summary(rows, at(2), coin_id="zz").first().points == 0
    known = served.coin_summary(rows, at(2), coin_id="a").first()
    # the first price is zero
    assert (known.points, known.net_change_pct) == (2, None)


def test_drawdown_skips_a_zero_peak(spark):
    out = risk.drawdown(ticks(spark, [0.0, 10.0, 4.0, 12.0, 9.0]))
    assert out.first().worst_drawdown == pytest.approx(-0.6)


def test_risk_parts_are_capped_and_banded(spark):
    calm = [(at(i), "calm", 1.0, 0.0, 0.0) for i in range(5)]
    wild = [(at(i), "wild", 1.0 + 9 * (i % 2), 90.0 * (i % 2), 5.0) for i in range(5)]
    raised = spark.createDataFrame(
        [(at(1), "wild", "W", 1.0, 9.0, "PUMP")] * 30 + [(at(1), "gone", "G", 1.0, 9.0, "PUMP")],
        schemas.ALERTS,
    )
    rows = metrics(spark, calm + wild)
    out = {r.coin_id: r for r in served.risk_score(rows, raised, at(6)).collect()}
    assert (out["calm"].risk_score, out["calm"].risk_band) == (0.0, "LOW")
    assert (out["wild"].risk_score, out["wild"].risk_band) == (100.0, "HIGH")
    assert (out["gone"].points, out["gone"].alerts_count) == (0, 1)
    assert out["gone"].risk_score == pytest.approx(0.7)
    asked = served.risk_score(rows, raised, at(6), coin_id="NONE").collect()
    assert [(r.coin_id, r.points, r.risk_band) for r in asked] == [("none", 0, "LOW")]


def _outcomes(spark, n_ok, n_bad):
    rows = [(f"r{i}", "t", "success", 1, 1, None, at(0)) for i in range(n_ok)]
    rows += [(f"b{i}", "u", "failure", 0, 1, "e", at(1)) for i in range(n_bad)]
    return spark.createDataFrame(rows, schemas.RUN_METRICS)


def test_quality_score_of_a_clean_table(spark):
    rows = metrics(spark, [(at(0), "a", 1.0, None, None), (at(1), "b", 1.0, None, None)])
    out = served.data_quality(rows, _outcomes(spark, 3, 0), at(2)).first()
    # one minute of lag costs one point
    assert (out.quality_score, out.status, out.coins_total) == (99.0, "GOOD", 2)
    ahead = served.data_quality(rows, _outcomes(spark, 3, 0), at(-9)).first()
    assert ahead.quality_score == 110.0


def test_quality_score_counts_faults(spark):
    rows = metrics(
        spark,
        [(at(0), "a", None, None, None)] * 3 + [(at(0), "a", 1.0, None, None)],
    )
    out = served.data_quality(rows, _outcomes(spark, 1, 9), at(0)).first()
    assert out.null_price_pct == 75.0
    assert out.duplicate_rows_total == 3
    # 100 - 20 (prices, capped) - 0.15 (duplicates) - 10 (failures, capped)
    assert (out.quality_score, out.status) == (69.85, "WARN")


def test_quality_of_an_empty_table(spark):
    none = spark.createDataFrame([], METRICS)
    out = served.data_quality(none, _outcomes(spark, 0, 0).limit(0), at(0)).first()
    assert (out.quality_score, out.lag_seconds, out.rows_total) == (100.0, None, 0)
    fresh = quality.freshness(none, at(0)).first()
    assert (fresh.last_data_at, fresh.data_lag_seconds) == (None, None)


def test_run_health(spark):
    out = runs.run_health(_outcomes(spark, 3, 1)).first()
    assert (out.success_rate_pct, out.all_latest_ok) == (75.0, False)
    assert runs.run_health(_outcomes(spark, 2, 0)).first().all_latest_ok is True


def test_stats_without_rows(spark):
    empty = spark.createDataFrame([], METRICS)
    out = served.stats(
        empty, empty, spark.createDataFrame([], schemas.ALERTS), _outcomes(spark, 1, 0).limit(0)
    ).first()
    assert (out.coins_tracked, out.total_alerts, out.pipeline_success_rate) == (0, 0, None)


@pytest.mark.parametrize(
    "call",
    [
        lambda m, r: served.coin_summary(m, at(0), 4),
        lambda m, r: served.coin_history(m, at(0), 1441),
        lambda m, r: served.ohlc_history(m, at(0), 4),
        lambda m, r: served.compare(m, "a,b", at(0), 14),
        lambda m, r: served.movers(m, at(0), 121),
        lambda m, r: served.movers(m, at(0), 5, 51),
        lambda m, r: served.run_failures(r, 201),
        lambda m, r: served.recent_dead_letters(r, 0),
        lambda m, r: served.anomalies(m, at(0), 9),
        lambda m, r: served.anomalies(m, at(0), 60, 6.5),
        lambda m, r: served.backtest(m, at(0), 59),
        lambda m, r: served.backtest(m, at(0), fee_bps=201),
        lambda m, r: served.backtest(m, at(0), initial_capital=99),
        lambda m, r: served.backtest(m, at(0), strategy="other"),
        lambda m, r: served.risk_score(m, r, at(0), 29),
        lambda m, r: served.data_quality(m, r, at(0), 10081),
    ],
)
def test_parameters_out_of_bounds(spark, call):
    with pytest.raises(ValueError):
        call(spark.createDataFrame([], METRICS), _outcomes(spark, 1, 0))


def test_backtest_of_one_key(spark):
    rows = metrics(spark, [(at(i), "a", 1.0, None, None) for i in range(3)])
    short = served.backtest(rows, at(5), coin_id="A")["result"].first()
    assert (short.coin_id, short.points, short.error is not None) == ("a", 3, True)
    absent = served.backtest(rows, at(5), coin_id="zz")["result"].first()
    assert (absent.coin_id, absent.points, absent.error is not None) == ("zz", 0, True)


def test_market_snapshot_parts(spark):
    rows = metrics(spark, [(at(i), f"k{k:02}", 1.0, None, None) for i in range(2) for k in range(40)])
    parts = served.market_snapshot(rows, _outcomes(spark, 1, 1), at(3))
    assert parts["latest"].count() == 30
    assert parts["stats"].first().coins_tracked == 40
    assert parts["anomalies"].count() == 0
    assert [r.task for r in parts["runs"].collect()] == ["t", "u"]


def test_clock_is_naive_utc():
    from tickloom.functions.clock import utc_now

    assert utc_now().tzinfo is None
    assert isinstance(utc_now(), datetime)
