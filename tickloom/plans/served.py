"""The read queries, each a function from frames, clock and parameters to a frame.

Queries on one key in a request are the same operator with a key filter; without it
they answer for every key. Bounds on the parameters are part of each contract.
"""

from __future__ import annotations

import dataclasses
from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.functions.bounds import bounds
from tickloom.functions.clock import recent
from tickloom.functions.numeric import round_half_up
from tickloom.functions.text import split_keys
from tickloom.operators import quality, runs
from tickloom.operators.anomalies import STRONG, anomalous
from tickloom.operators.compare import (
    listed_keys,
    one_key,
    series_stats,
    tabled_keys,
    top_pair,
    window_stats,
)
from tickloom.operators.hotkeys import DEFAULT_POLICY, SplitPolicy
from tickloom.operators.ranking import latest_per_key, newest, top
from tickloom.operators.risk import risk_scores
from tickloom.operators.signals import (
    STRATEGY,
    cross_actions,
    cross_backtest,
    cross_run,
    cross_trades,
)
from tickloom.schemas import ALERTS, METRIC_COLUMNS, MOVERS

BY_TIME = ("timestamp",)

# Row limits and windows that requests cannot change.
ALERT_ROWS = 50
ANOMALY_ROWS = 100
SNAPSHOT_KEYS = 30
SNAPSHOT_ANOMALIES = 10
SNAPSHOT_MINUTES = 60


def freshness(metrics: DataFrame, as_of: datetime) -> DataFrame:
    return quality.freshness(metrics, as_of)


def latest_prices(metrics: DataFrame, order: Sequence[str] = BY_TIME) -> DataFrame:
    return latest_per_key(metrics, order=order).select(*METRIC_COLUMNS).orderBy("id")


def coin_list(metrics: DataFrame) -> DataFrame:
    return metrics.select("id", "symbol").distinct().orderBy("id", "symbol")


@bounds(minutes=(5, 1440))
def coin_summary(
    metrics: DataFrame,
    as_of: datetime,
    minutes: int = 60,
    coin_id: str | None = None,
    order: Sequence[str] = BY_TIME,
) -> DataFrame:
    """Per key; for one named key always one row, with zero points if it has none."""
    rows = recent(metrics, as_of, minutes)
    stats = {
        **series_stats(order),
        "avg_volatility": round_half_up(F.avg("volatility"), 6),
    }
    columns = [value.alias(name) for name, value in stats.items()]
    if coin_id is None:
        return rows.groupBy(F.col("id").alias("coin_id")).agg(*columns)
    one = rows.filter(F.col("id") == coin_id).agg(*columns)
    return one.select(F.lit(coin_id).alias("coin_id"), *stats)


@bounds(minutes=(5, 1440))
def coin_history(
    metrics: DataFrame, as_of: datetime, minutes: int = 60, coin_id: str | None = None
) -> DataFrame:
    rows = recent(metrics, as_of, minutes)
    shown = [name for name in METRIC_COLUMNS if name not in ("id", "symbol")]
    if coin_id is None:
        return rows.select("id", *shown).orderBy("id", "timestamp")
    return rows.filter(F.col("id") == coin_id).select(*shown).orderBy("timestamp")


@bounds(minutes=(5, 1440))
def ohlc_history(
    candles: DataFrame, as_of: datetime, minutes: int = 60, coin_id: str | None = None
) -> DataFrame:
    rows = recent(candles, as_of, minutes)
    shown = ["timestamp", "open", "high", "low", "close"]
    if coin_id is None:
        return rows.select("id", *shown).orderBy("id", "timestamp")
    return rows.filter(F.col("id") == coin_id).select(*shown).orderBy("timestamp")


def compare_latest(
    metrics: DataFrame, ids: Sequence[str] | DataFrame, order: Sequence[str] = BY_TIME
) -> DataFrame:
    latest = latest_per_key(listed_keys(metrics, ids), order=order).select(*METRIC_COLUMNS)
    return tabled_keys(latest, ids).orderBy("id")


@bounds(minutes=(15, 1440))
def compare_stats(
    metrics: DataFrame,
    ids: Sequence[str] | DataFrame,
    as_of: datetime,
    minutes: int = 180,
    order: Sequence[str] = BY_TIME,
) -> DataFrame:
    rows = recent(listed_keys(metrics, ids), as_of, minutes)
    return tabled_keys(window_stats(rows, order), ids).orderBy("id")


@bounds(minutes=(15, 1440))
def pair_corr(
    metrics: DataFrame, ids: Sequence[str], as_of: datetime, minutes: int = 180
) -> DataFrame:
    return top_pair(recent(metrics, as_of, minutes), ids)


def compare(
    metrics: DataFrame,
    ids: str,
    as_of: datetime,
    minutes: int = 180,
    order: Sequence[str] = BY_TIME,
) -> dict[str, DataFrame]:
    """All three parts for a comma list of at least two keys."""
    keys = split_keys(ids)
    return {
        "latest": compare_latest(metrics, keys, order),
        "window_stats": compare_stats(metrics, keys, as_of, minutes, order),
        "top_pair_correlation": pair_corr(metrics, keys, as_of, minutes),
    }


def snapshot_ranking(snapshot: DataFrame) -> DataFrame:
    """Stored gainers or losers by rank."""
    return snapshot.select(*MOVERS.fieldNames()).orderBy("rank")


@bounds(minutes=(1, 120), limit=(1, 50))
def movers(
    metrics: DataFrame,
    as_of: datetime,
    minutes: int = 5,
    limit: int = 5,
    order: Sequence[str] = BY_TIME,
) -> dict[str, DataFrame]:
    """Largest rises and falls of the look-back.

    Unlike the stored snapshot, a key counts with its newest row that has a change.
    """
    known = recent(metrics, as_of, minutes).filter(F.col("change_5min").isNotNull())
    latest = latest_per_key(known, order=order).select("id", "symbol", "price", "change_5min")
    return {
        "gainers": top(latest, limit, F.col("change_5min").desc()),
        "losers": top(latest, limit, F.col("change_5min").asc()),
    }


def recent_alerts(alerts: DataFrame, limit: int = ALERT_ROWS) -> DataFrame:
    return newest(alerts, limit, ["alerted_at", "coin_id"]).select(*ALERTS.fieldNames())


def run_latest(run_metrics: DataFrame, order: Sequence[str] = ("created_at",)) -> DataFrame:
    return runs.run_latest(run_metrics, order).orderBy("task")


@bounds(limit=(1, 200))
def run_failures(
    run_metrics: DataFrame, limit: int = 20, order: Sequence[str] = ("created_at", "run_id")
) -> DataFrame:
    return runs.run_failures(run_metrics, limit, order)


@bounds(limit=(1, 200))
def recent_dead_letters(
    letters: DataFrame, limit: int = 20, order: Sequence[str] = ("created_at", "run_id")
) -> DataFrame:
    return newest(letters, limit, order).select("run_id", "error_message", "created_at")


@bounds(minutes=(10, 1440), zscore=(1.0, 6.0))
def anomalies(
    metrics: DataFrame,
    as_of: datetime,
    minutes: int = 60,
    zscore: float = 2.0,
    policy: SplitPolicy = DEFAULT_POLICY,
) -> DataFrame:
    shown = ["id", "symbol", "timestamp", "price", "change_5min"]
    rows = anomalous(recent(metrics, as_of, minutes).select(*shown), zscore, policy)
    return (
        rows.orderBy(F.abs("z").desc(), F.desc("timestamp"), "id")
        .limit(ANOMALY_ROWS)
        .select(*shown, round_half_up(F.col("z"), 4).alias("z_score"))
    )


@bounds(minutes=(60, 10080), initial_capital=(100.0, 1_000_000.0), fee_bps=(0.0, 200.0))
def backtest(
    metrics: DataFrame,
    as_of: datetime,
    minutes: int = 1440,
    coin_id: str | None = None,
    strategy: str = STRATEGY,
    initial_capital: float = 1000.0,
    fee_bps: float = 10.0,
    order: Sequence[str] = BY_TIME,
    policy: SplitPolicy = DEFAULT_POLICY,
) -> dict[str, DataFrame]:
    """Result per key, its trades, and its last actions."""
    if strategy != STRATEGY:
        raise ValueError(f"Only strategy={STRATEGY} is currently supported.")
    rows = recent(metrics, as_of, minutes)
    if coin_id is not None:
        rows = rows.filter(F.col("id") == coin_id.lower())
    run = cross_run(rows, order, policy)
    if coin_id is not None:
        asked = one_key(metrics, coin_id.lower()).join(run.series, "id", "left")
        series = asked.withColumn("points", F.coalesce("points", F.lit(0)))
        run = dataclasses.replace(run, series=series)
    return {
        "result": cross_backtest(run, minutes, initial_capital, fee_bps),
        "trades": cross_trades(run),
        "recent_actions": cross_actions(run, initial_capital, fee_bps),
    }


@bounds(minutes=(30, 10080))
def risk_score(
    metrics: DataFrame,
    alerts: DataFrame,
    as_of: datetime,
    minutes: int = 240,
    coin_id: str | None = None,
    order: Sequence[str] = BY_TIME,
    policy: SplitPolicy = DEFAULT_POLICY,
) -> DataFrame:
    rows = recent(metrics, as_of, minutes)
    alerted = recent(alerts, as_of, minutes, "alerted_at")
    keys = None
    if coin_id is not None:
        keys = one_key(metrics, coin_id.lower())
        rows = rows.filter(F.col("id") == coin_id.lower())
        alerted = alerted.filter(F.col("coin_id") == coin_id.lower())
    return risk_scores(rows, alerted, order, policy, keys).withColumn(
        "window_minutes", F.lit(minutes)
    )


@bounds(minutes=(10, 10080))
def data_quality(
    metrics: DataFrame, run_metrics: DataFrame, as_of: datetime, minutes: int = 60
) -> DataFrame:
    outcomes = runs.outcome_counts(recent(run_metrics, as_of, minutes, "created_at"))
    return quality.quality_report(metrics, outcomes, as_of, minutes).withColumn(
        "window_minutes", F.lit(minutes)
    )


def stats(
    metrics: DataFrame, candles: DataFrame, alerts: DataFrame, run_metrics: DataFrame
) -> DataFrame:
    """Seven counts and a rate, one pass per table."""

    def size(table: DataFrame):
        return table.agg(F.count(F.lit(1))).scalar()

    outcomes = run_metrics.agg(
        F.struct(
            F.count(F.lit(1)).alias("events"),
            F.count_if(F.col("status") == runs.OK).alias("successes"),
            runs.success_rate().alias("rate"),
        )
    ).scalar()
    return (
        _tracked(metrics)
        .select(
            "*",
            size(candles).alias("ohlcv_candles"),
            size(alerts).alias("total_alerts"),
            outcomes.alias("_runs"),
        )
        .select(
            "coins_tracked",
            "last_updated",
            "ohlcv_candles",
            "total_alerts",
            F.col("_runs.events").alias("pipeline_events"),
            F.col("_runs.successes").alias("pipeline_successes"),
            F.col("_runs.rate").alias("pipeline_success_rate"),
        )
    )


def _tracked(metrics: DataFrame) -> DataFrame:
    """Exact distinct keys and the newest time, by key first."""
    by_key = metrics.groupBy("id").agg(F.max("timestamp").alias("_newest"))
    return by_key.agg(
        F.count("id").alias("coins_tracked"), F.max("_newest").alias("last_updated")
    )


def market_snapshot(
    metrics: DataFrame,
    run_metrics: DataFrame,
    as_of: datetime,
    order: Sequence[str] = BY_TIME,
    run_order: Sequence[str] = ("created_at",),
    policy: SplitPolicy = DEFAULT_POLICY,
    minutes: int = SNAPSHOT_MINUTES,
    kept: DataFrame | None = None,
) -> Mapping[str, DataFrame]:
    """The four parts of the periodic snapshot.

    With ``kept``, the maintained table of latest rows, no part reads more of the metrics than
    the last ``minutes``.
    """
    shown = ["id", "symbol", "timestamp", "price", "change_5min"]
    newest_rows = metrics if kept is None else kept
    latest = latest_per_key(newest_rows, order=order).select(
        "id", "symbol", "timestamp", "price", "change_1min", "change_5min"
    )
    odd = anomalous(recent(metrics, as_of, minutes).select(*shown), STRONG, policy)
    return {
        "stats": _tracked(newest_rows),
        "latest": latest.orderBy("id").limit(SNAPSHOT_KEYS),
        "anomalies": newest(odd, SNAPSHOT_ANOMALIES, ["timestamp", "id"]).select(*shown),
        "runs": run_latest(run_metrics, run_order),
    }
