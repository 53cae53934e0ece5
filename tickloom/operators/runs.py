"""Run metrics: totals, latest outcome per task, failures, health."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions.numeric import round_half_up
from tickloom.operators.ranking import latest_per_key, newest

OK = "success"


def succeeded() -> Column:
    return F.col("status") == OK


def run_totals(run_metrics: DataFrame) -> DataFrame:
    """Published records per run."""
    return run_metrics.groupBy("run_id").agg(
        F.coalesce(F.sum("records_pushed"), F.lit(0)).alias("total_pushed")
    )


def run_latest(run_metrics: DataFrame, order: Sequence[str] = ("created_at",)) -> DataFrame:
    """The newest outcome of each task."""
    return latest_per_key(run_metrics, ["task"], order).select(
        "task", "status", "records_pushed", "latency_ms", "created_at"
    )


def run_failures(
    run_metrics: DataFrame, limit: int, order: Sequence[str] = ("created_at", "run_id")
) -> DataFrame:
    return newest(run_metrics.filter(~succeeded()), limit, order).select(
        "run_id", "task", "status", "latency_ms", "error_message", "created_at"
    )


def outcome_counts(run_metrics: DataFrame) -> DataFrame:
    """Successes and failures in one row, zeros for an empty frame."""
    return run_metrics.agg(
        F.count_if(succeeded()).alias("success_count"),
        F.count_if(~succeeded()).alias("failure_count"),
    )


def run_health(run_metrics: DataFrame, order: Sequence[str] = ("created_at",)) -> DataFrame:
    """Counts, success rate in percent, and whether every task's newest run succeeded."""
    all_ok = run_latest(run_metrics, order).agg(F.bool_and(succeeded()).alias("all_ok"))
    return run_metrics.agg(
        F.count(F.lit(1)).alias("events"),
        F.count_if(succeeded()).alias("success_count"),
        F.count_if(~succeeded()).alias("failure_count"),
        success_rate().alias("success_rate_pct"),
    ).select("*", all_ok.scalar().alias("all_latest_ok"))


def success_rate() -> Column:
    """Aggregate: percent of successes, two places, null without rows."""
    return round_half_up(
        F.try_divide(F.count_if(succeeded()), F.count(F.lit(1))) * 100, 2
    )
