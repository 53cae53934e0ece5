"""Rows whose change is far from the key's own mean."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.operators.hotkeys import DEFAULT_POLICY, SplitPolicy, join_per_key

# Fixed value: the bound used by the snapshot and the risk score.
STRONG = 2.5


def z_scores(metrics: DataFrame, policy: SplitPolicy = DEFAULT_POLICY) -> DataFrame:
    """Rows with a known change plus ``z``, the distance from the key's mean in deviations.

    Keys whose changes are all equal have no z-score and drop out. The mean and
    deviation are aggregates, joined back, so no task has to hold a whole key.
    """
    known = metrics.filter(F.col("change_5min").isNotNull())
    stats = (
        known.groupBy("id")
        .agg(
            F.avg("change_5min").alias("_mean"),
            F.stddev_pop("change_5min").alias("_dev"),
            F.count(F.lit(1)).alias("_known"),
        )
        .filter(F.col("_dev") > 0)
    )
    z = (F.col("change_5min") - F.col("_mean")) / F.col("_dev")
    return (
        join_per_key(known, stats, "_known", policy=policy)
        .withColumn("z", z)
        .select(*metrics.columns, "z")
    )


def anomalous(
    metrics: DataFrame, bound: float, policy: SplitPolicy = DEFAULT_POLICY
) -> DataFrame:
    """Rows at least ``bound`` deviations away, either way."""
    return z_scores(metrics, policy).filter(F.abs("z") >= bound)


def anomaly_count(
    metrics: DataFrame, bound: float = STRONG, policy: SplitPolicy = DEFAULT_POLICY
) -> DataFrame:
    return anomalous(metrics, bound, policy).groupBy("id").agg(
        F.count(F.lit(1)).alias("anomaly_count")
    )
