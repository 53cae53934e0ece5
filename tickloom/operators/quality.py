"""Freshness, duplicates, completeness and the quality score of a metrics table."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions.clock import instant, lag_seconds
from tickloom.functions.numeric import at_most, round_half_up

# Penalty per unit and its ceiling, and the status edges.
LAG_PER_SECOND, LAG_CEILING = 1 / 60.0, 35.0
NULL_PRICE_WEIGHT, NULL_PRICE_CEILING = 1.2, 20.0
NULL_MEAN_WEIGHT, NULL_MEAN_CEILING = 0.6, 15.0
DUPLICATE_WEIGHT, DUPLICATE_CEILING = 0.05, 20.0
FAILURE_WEIGHT, FAILURE_CEILING = 2.0, 10.0
WARN_BELOW, CRITICAL_BELOW = 70.0, 45.0


def freshness(metrics: DataFrame, as_of: datetime) -> DataFrame:
    """Newest time and its distance from the clock; both null for an empty table."""
    return metrics.agg(F.max("timestamp").alias("last_data_at")).withColumn(
        "data_lag_seconds", lag_seconds(as_of, F.col("last_data_at"))
    )


def _surplus(count: Column) -> Column:
    return F.coalesce(F.sum(count - 1), F.lit(0))


def duplicates(metrics: DataFrame) -> DataFrame:
    """Rows beyond the first of each (id, timestamp)."""
    return (
        metrics.groupBy("id", "timestamp")
        .agg(F.count(F.lit(1)).alias("_n"))
        .agg(_surplus(F.col("_n")).alias("duplicate_rows"))
    )


def profile(metrics: DataFrame, as_of: datetime, minutes: int) -> DataFrame:
    """Volume, completeness and duplicates in one pass: by (id, time), by id, overall."""
    in_window = F.col("timestamp") >= instant(as_of - timedelta(minutes=minutes))
    by_point = (
        metrics.groupBy("id", "timestamp")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count_if(F.col("price").isNull()).alias("no_price"),
            F.count_if(F.col("sma").isNull() | F.col("ema").isNull()).alias("no_mean"),
        )
        .withColumn("recent", F.coalesce(in_window, F.lit(False)))
    )

    def windowed(name: str) -> Column:
        return F.sum(F.when(F.col("recent"), F.col(name)).otherwise(0))

    by_key = by_point.groupBy("id").agg(
        F.sum("n").alias("n"),
        _surplus(F.col("n")).alias("surplus"),
        windowed("n").alias("n_recent"),
        windowed("no_price").alias("no_price"),
        windowed("no_mean").alias("no_mean"),
        F.max("timestamp").alias("newest"),
    )

    def total(name: str) -> Column:
        return F.coalesce(F.sum(name), F.lit(0))

    def share(name: str) -> Column:
        part = F.try_divide(total(name), total("n_recent")) * 100
        return F.coalesce(round_half_up(part, 4), F.lit(0.0))

    keyed = F.col("id").isNotNull()
    return by_key.agg(
        total("n_recent").alias("rows_window"),
        F.count_if(keyed & (F.col("n_recent") > 0)).alias("coins_window"),
        total("n").alias("rows_total"),
        F.count_if(keyed).alias("coins_total"),
        F.max("newest").alias("last_data_at"),
        share("no_price").alias("null_price_pct"),
        share("no_mean").alias("null_ma_pct"),
        total("surplus").alias("duplicate_rows_total"),
    ).withColumn("lag_seconds", lag_seconds(as_of, F.col("last_data_at")))


def quality_report(
    metrics: DataFrame, outcomes: DataFrame, as_of: datetime, minutes: int
) -> DataFrame:
    """The profile with run outcomes (one row), a score and a status.

    There is no upper end: data ahead of the clock scores above 100.
    """
    report = profile(metrics, as_of, minutes).select(
        "*",
        outcomes.select("success_count").scalar().alias("success_count"),
        outcomes.select("failure_count").scalar().alias("failure_count"),
    )
    # an unknown lag costs nothing, which is what at_most makes of a null
    score = (
        F.lit(100.0)
        - at_most(F.col("lag_seconds") * LAG_PER_SECOND, LAG_CEILING)
        - at_most(F.col("null_price_pct") * NULL_PRICE_WEIGHT, NULL_PRICE_CEILING)
        - at_most(F.col("null_ma_pct") * NULL_MEAN_WEIGHT, NULL_MEAN_CEILING)
        - at_most(F.col("duplicate_rows_total") * DUPLICATE_WEIGHT, DUPLICATE_CEILING)
        - at_most(F.col("failure_count") * FAILURE_WEIGHT, FAILURE_CEILING)
    )
    scored = report.withColumn("quality_score", F.greatest(round_half_up(score, 2), F.lit(0.0)))
    status = (
        F.when(F.col("quality_score") < CRITICAL_BELOW, "CRITICAL")
        .when(F.col("quality_score") < WARN_BELOW, "WARN")
        .otherwise("GOOD")
    )
    return scored.withColumn("status", status)
