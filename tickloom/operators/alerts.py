"""Threshold alerts on the latest change of each key."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions.clock import instant
from tickloom.schemas import ALERTS

# Alert names and the default threshold in percent.
UP, DOWN = "PUMP", "DUMP"
DEFAULT_THRESHOLD = 2.0


def price_alerts(
    latest: DataFrame, alerted_at: datetime | Column, threshold: float = DEFAULT_THRESHOLD
) -> DataFrame:
    """Rows that moved by at least ``threshold`` percent either way, ends included."""
    at = instant(alerted_at) if isinstance(alerted_at, datetime) else alerted_at
    change = F.col("change_5min")
    kind = F.when(change >= threshold, UP).when(change <= -threshold, DOWN)
    return (
        latest.withColumns({"alerted_at": at, "alert_type": kind})
        .filter(F.col("alert_type").isNotNull())
        .withColumnRenamed("id", "coin_id")
        .select(*ALERTS.fieldNames())
    )
