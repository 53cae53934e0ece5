"""Small frames for the tests."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession

START = datetime(2024, 1, 1)


def at(minutes: float) -> datetime:
    return START + timedelta(minutes=minutes)


def ticks(spark: SparkSession, prices, key: str = "a") -> DataFrame:
    """One key, one tick a minute."""
    rows = [(at(i), key, key.upper(), p, i) for i, p in enumerate(prices)]
    return spark.createDataFrame(
        rows, "timestamp timestamp_ntz, id string, symbol string, price double, seq long"
    )


def rows_of(frame: DataFrame, *columns: str) -> list[tuple]:
    columns = columns or tuple(frame.columns)
    return [tuple(r[c] for c in columns) for r in frame.collect()]
