from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from tests.data import at, rows_of
from tickloom import schemas
from tickloom.operators.validation import EMPTY_BATCH, NONE_VALID
from tickloom.plans import publish_run as publishing
from tickloom.session import scratch
from tickloom.settings import Settings
from tickloom.sinks.tables import read_table
from tickloom.sources.messages import flatten


def record(key, price):
    return {"id": key, "symbol": "S", "current_price": price, "extra": 1}


@pytest.fixture
def run(spark):
    settings = Settings(tables=scratch(spark, "tables"), expected_records=3)
    return publishing.PublishingRun(spark, settings, "run-1", at(5))


def lines(spark, *responses):
    texts = [(r if isinstance(r, str) else json.dumps(r),) for r in responses]
    return spark.createDataFrame(texts, "value string")


def logged(run):
    frame = read_table(run.spark, f"{run.settings.tables}/run_metrics", schemas.RUN_METRICS)
    return sorted(rows_of(frame, "run_id", "task", "status", "records_pushed"))


def letters(run):
    frame = read_table(run.spark, f"{run.settings.tables}/dead_letters", schemas.DEAD_LETTERS)
    return sorted(rows_of(frame, "run_id", "payload", "error_message"), key=str)


def test_a_run_sends_valid_records_and_logs_each_step(spark, run):
    bus = scratch(spark, "bus")
    send = lambda messages: messages.write.mode("append").text(bus)
    first = [record("a", 1.5), record("b", -1), record(None, 2)]
    assert publishing.publish_batch(run, lines(spark, first), 1, send) == publishing.Published(1, 2, False)
    second = [record("c", 2)]
    assert publishing.publish_batch(run, lines(spark, second), 2, send) == publishing.Published(1, 0, True)

    sent = spark.read.text(bus)
    assert sorted(rows_of(flatten(sent), "timestamp", "id", "price")) == [
        (str(at(5)), "a", 1.5),
        (str(at(5)), "c", 2.0),
    ]
    topic = sent.select(F.lit("t").alias("topic"), F.lit(0).alias("partition"), F.monotonically_increasing_id().alias("offset"), "value")
    assert publishing.verify(run, topic) == 1
    assert publishing.finish(run) == 2
    assert logged(run) == [
        ("run-1", "dag_completed", "success", 2),
        ("run-1", "fetch_and_push.batch_1", "success", 1),
        ("run-1", "fetch_and_push.batch_2", "success", 1),
        ("run-1", "verify_kafka_delivery", "success", 1),
    ]
    got = letters(run)
    assert {r for r, _, _ in got} == {"run-1"}
    assert sorted(e for _, _, e in got) == ["Invalid price: -1", "Missing required fields: ['id']"]
    assert {json.loads(p)["extra"] for _, p, _ in got} == {1}


@pytest.mark.parametrize(
    "response, error",
    [
        ("[]", EMPTY_BATCH),
        ('{"id": "a"}', publishing.NO_LIST),
        ([record("a", 0)], NONE_VALID),
    ],
)
def test_bad_batches_fail_and_are_logged(spark, run, response, error):
    with pytest.raises(ValueError, match=error[:15]):
        publishing.publish_batch(run, lines(spark, response), 1, lambda messages: None)
    assert logged(run) == [("run-1", "fetch_and_push.batch_1", "failure", 0)]


def test_a_failed_send_leaves_a_letter_without_content(spark, run):
    def send(messages):
        raise RuntimeError("no broker")

    with pytest.raises(RuntimeError):
        publishing.publish_batch(run, lines(spark, [record("a", 1)]), 1, send)
    assert letters(run) == [("run-1", None, "Kafka push failed: no broker")]
    assert logged(run) == [("run-1", "fetch_and_push.batch_1", "failure", 0)]


def test_a_missing_message_fails_the_check(spark, run):
    none = spark.createDataFrame([], "topic string, partition int, offset long, value string")
    with pytest.raises(RuntimeError):
        publishing.verify(run, none)
    assert logged(run) == [("run-1", "verify_kafka_delivery", "failure", 0)]
