"""The physical plans that the operators are written for."""

from __future__ import annotations

import re
from datetime import datetime

from tests.data import at
from tickloom import schemas
from tickloom.functions.clock import recent
from tickloom.operators import anomalies, features, ranking, validation
from tickloom.operators.candles import candles
from tickloom.operators.hotkeys import SplitPolicy, hot_keys, no_key_is_hot, time_cuts
from tickloom.operators.risk import drawdown
from tickloom.registry import views
from tickloom.session import scratch
from tickloom.sinks import tables
from tickloom.sources import lake, messages
from tickloom.streaming import ingest

SF_DIR = "/root/testdata/sf0.001"


def plan_of(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


def shuffles(plan: str) -> int:
    return len(re.findall(r"Exchange (hash|range|Single)", plan))


def test_a_look_back_prunes_dates_and_pushes_the_time_bound(spark):
    path = scratch(spark, "lake")
    tables.append(views.ticks_user(spark, SF_DIR), path, "timestamp")
    plan = plan_of(recent(lake.scan_ticks(spark, path), datetime(2024, 1, 31), 600))
    assert re.search(r"PartitionFilters: \[[^\]]*dt#\d+ >= 2024-01-30", plan)
    assert "GreaterThanOrEqual(timestamp" in plan


def test_features_shuffle_once_and_read_their_columns_only(spark):
    plan = plan_of(features.features(views.ticks_user(spark, SF_DIR), views.USER_ORDER))
    assert shuffles(plan) == 1
    assert "props" not in plan and plan.count("Sort [") == 1


def test_latest_rows_are_cut_before_the_shuffle(spark):
    plan = plan_of(features.latest_features(views.ticks_user(spark, SF_DIR), views.USER_ORDER))
    assert shuffles(plan) == 1
    before_shuffle = plan[plan.index("Exchange hash") :]
    assert "WindowGroupLimit" in before_shuffle and "Partial" in before_shuffle


def test_top_rows_are_taken_without_a_full_sort(spark):
    latest = features.latest_features(views.ticks_user(spark, SF_DIR), views.USER_ORDER)
    plan = plan_of(ranking.top_gainers(latest))
    assert "TakeOrderedAndProject" in plan


def test_candles_by_time_combine_by_hash_before_the_shuffle(spark):
    plan = plan_of(candles(views.ticks_type(spark, SF_DIR)))
    assert "SortAggregate" not in plan
    assert "partial_min_by" in plan[plan.index("Exchange hash") :]


def test_cuts_combine_before_their_shuffles(spark):
    rows = views.ticks_type(spark, SF_DIR)
    assert "partial_count" in plan_of(hot_keys(rows, policy=SplitPolicy(100, 10)))
    assert time_cuts(rows, policy=SplitPolicy(100, 10)).count() == 5
    assert time_cuts(rows, policy=SplitPolicy(10**6, 10)) is None


def test_no_hot_key_means_the_plain_plan(spark):
    rows = views.ticks_type(spark, SF_DIR)
    cut = SplitPolicy(hot_rows=200_000, slice_rows=10)  # above the largest key, below the estimate
    if not no_key_is_hot(rows, cut):
        cut = SplitPolicy(hot_rows=10**9, slice_rows=10)
    plain = plan_of(features.features(rows, views.USER_ORDER))
    counted = features.features(rows, views.USER_ORDER, cut)
    assert shuffles(plan_of(counted)) == shuffles(plain) == 1


def test_short_statistics_are_broadcast_and_rows_not_shuffled(spark):
    metrics = spark.createDataFrame(
        [(at(i), "a", "A", 1.0, None, float(i), 1.0, 1.0, None) for i in range(100)],
        schemas.METRICS,
    )
    plan = plan_of(anomalies.z_scores(metrics, SplitPolicy(hot_rows=10)))
    assert "BroadcastHashJoin" in plan and shuffles(plan) == 0
    spread = plan_of(anomalies.z_scores(metrics, SplitPolicy(10, 5, broadcast_rows=0)))
    assert "_salt" in spread



def test_drawdown_of_cut_keys_joins_nothing_back(spark):
    plan = plan_of(drawdown(views.ticks_type(spark, SF_DIR), policy=SplitPolicy(100, 10)))
    assert "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan
    assert plan.count("Join") == plan.count("BroadcastHashJoin")


def test_an_exploded_record_carries_none_of_its_message(spark):
    path = scratch(spark, "inbox")
    messages.envelopes(views.quotes(spark, SF_DIR)).select("value").write.text(path)
    feed = messages.read_messages(spark, "text", {}, path, streaming=False)
    plan = plan_of(validation.valid_quotes(ingest.quotes_of(feed)))
    # no column beside the record, and the message is parsed once
    assert re.search(r"Generate explode\(.*\), false, \[\w+#\d+\]", plan)
    assert plan.count("from_json(") == 1
