"""One publishing run: upstream responses to messages, with rejects and run metrics."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime
from time import monotonic

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.functions.clock import instant
from tickloom.operators.reconcile import verify_delivery
from tickloom.operators.runs import run_totals
from tickloom.operators.validation import (
    EMPTY_BATCH,
    NONE_VALID,
    dead_letters,
    failed_batch_letter,
    project_quote,
    valid_quotes,
)
from tickloom.plans.analytics_run import run_metric
from tickloom.schemas import RUN_METRICS
from tickloom.settings import Settings
from tickloom.sinks import tables
from tickloom.sinks.tables import read_table
from tickloom.sources.messages import envelopes, landed_quotes, response_guard

# Task names and the failure texts.
PUBLISH_TASK = "fetch_and_push.batch_{}"
VERIFY_TASK = "verify_kafka_delivery"
DONE_TASK = "dag_completed"
NO_LIST = "Expected list from API"
SEND_FAILED = "Kafka push failed: {}"


@dataclass(frozen=True)
class Published:
    """What one batch sent. A short batch is worth a warning, not a failure."""

    records: int
    rejected: int
    below_expected: bool


@dataclass(frozen=True)
class PublishingRun:
    """Where a run logs, and under which id and clock."""

    spark: SparkSession
    settings: Settings
    run_id: str
    as_of: datetime

    def log(
        self, task: str, started: float, records: int = 0, failure: Exception | None = None
    ) -> None:
        status = "failure" if failure else "success"
        spent = int((monotonic() - started) * 1000)
        error = str(failure) if failure else None
        row = run_metric(
            self.spark, self.run_id, task, status, self.as_of, records, spent, error
        )
        tables.append(row, f"{self.settings.tables}/run_metrics", "created_at")

    def reject(self, letters: DataFrame, batch: str) -> None:
        path = f"{self.settings.tables}/dead_letters"
        tables.append_run(letters, path, f"{self.run_id}-{batch}", "created_at")


def publish_batch(
    run: PublishingRun, lines: DataFrame, batch: int, send: Callable[[DataFrame], None]
) -> Published:
    """Validate one fetch and send its records; ``send`` gets messages in ``value``.

    Rejected records become dead letters. A failure is logged and raised, and a
    failed send also leaves a dead letter without content.
    """
    started = monotonic()
    task = PUBLISH_TASK.format(batch)
    landed = landed_quotes(lines).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        result = _publish(run, lines, landed, batch, send)
    except Exception as failure:
        run.log(task, started, failure=failure)
        raise
    finally:
        landed.unpersist()
    run.log(task, started, result.records)
    return result


def _publish(run, lines, landed, batch, send) -> Published:
    seen = response_guard(lines).agg(
        F.coalesce(F.bool_and("is_list"), F.lit(True)).alias("lists"),
        F.coalesce(F.sum("records"), F.lit(0)).alias("records"),
    ).first()
    if not seen.lists:
        raise ValueError(NO_LIST)
    if not seen.records:
        raise ValueError(EMPTY_BATCH)

    run.reject(dead_letters(landed, run.run_id, run.as_of, F.col("payload")), f"records_{batch}")
    valid = valid_quotes(landed)
    kept = valid.count()
    if not kept:
        raise ValueError(NONE_VALID)
    stamped = project_quote(valid).withColumn("timestamp", instant(run.as_of))
    try:
        send(envelopes(stamped).select("value"))
    except Exception as failure:
        text = SEND_FAILED.format(failure)
        run.reject(failed_batch_letter(run.spark, run.run_id, text, run.as_of), f"send_{batch}")
        raise
    return Published(kept, seen.records - kept, seen.records < run.settings.expected_records)


def verify(run: PublishingRun, messages: DataFrame) -> int:
    """Records in the newest message of the topic; fails if there is none or it is malformed."""
    started = monotonic()
    found = verify_delivery(messages).first()
    if found.error_message:
        failure = RuntimeError(found.error_message)
        run.log(VERIFY_TASK, started, failure=failure)
        raise failure
    run.log(VERIFY_TASK, started, found.records)
    return found.records


def finish(run: PublishingRun) -> int:
    """Log and return the records that all batches of the run sent."""
    started = monotonic()
    logged = read_table(run.spark, f"{run.settings.tables}/run_metrics", RUN_METRICS)
    batches = logged.filter(
        (F.col("run_id") == run.run_id)
        & (F.col("status") == "success")
        & F.col("task").startswith(PUBLISH_TASK.format(""))
        & (F.col("dt") == F.lit(run.as_of.date()))
    )
    total = run_totals(batches).first()
    sent = int(total.total_pushed) if total else 0
    run.log(DONE_TASK, started, sent)
    return sent
