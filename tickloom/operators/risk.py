"""Drawdown and the risk score of each key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickloom.functions.numeric import at_most, clamp, round_half_up, zero_if_null
from tickloom.operators.anomalies import anomaly_count
from tickloom.operators.hotkeys import (
    DEFAULT_POLICY,
    SplitPolicy,
    no_key_is_hot,
    time_cuts,
    with_slices,
)

# Weight and ceiling of each part of the score, and the band edges.
VOLATILITY = {"weight": 25.0, "ceiling": 35.0}
MOVE = {"weight": 8.0, "ceiling": 25.0}
DRAWDOWN = {"weight": 0.8, "ceiling": 25.0}
SIGNALS = {"alert": 0.7, "anomaly": 1.2, "ceiling": 15.0}
BANDS = {"HIGH": 70.0, "MEDIUM": 40.0}
LOWEST_BAND = "LOW"


def drawdown(
    metrics: DataFrame,
    order: Sequence[str] = ("timestamp",),
    policy: SplitPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """Worst fall from the running peak per key, as a fraction; a zero peak is skipped.

    Prices are not negative (validated). A key is cut into slices only if it is hot. A slice
    keeps its worst fall from its own peaks, its highest and its lowest price; with the peak of
    the slices before it, these tell its worst fall from any peak, so rows are read once and
    nothing is joined back to them.
    """
    prices = metrics.select(*dict.fromkeys(["id", *order, "price"]))
    plain = no_key_is_hot(prices, policy)
    cuts = None if plain else time_cuts(prices, ["id"], order[0], policy)
    so_far = (Window.unboundedPreceding, Window.currentRow)
    if cuts is None:
        whole = Window.partitionBy("id").orderBy(*order).rowsBetween(*so_far)
        fall = F.try_divide(F.col("price"), F.max("price").over(whole)) - 1
        return prices.withColumn("_fall", fall).groupBy("id").agg(
            F.min("_fall").alias("worst_drawdown")
        )
    inside = Window.partitionBy("id", "_slice").orderBy(*order).rowsBetween(*so_far)
    earlier = Window.partitionBy("id").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    # one row for each slice of a key
    slices = (
        with_slices(prices, ["id"], order[0], cuts)
        .withColumn("_part", F.try_divide(F.col("price"), F.max("price").over(inside)))
        .groupBy("id", "_slice")
        .agg(F.min("_part").alias("_part"), F.max("price").alias("_top"), F.min("price").alias("_low"))
        .withColumn("_peak", F.max("_top").over(earlier))
    )
    part = F.least("_part", F.try_divide(F.col("_low"), F.col("_peak")))
    return slices.groupBy("id").agg((F.min(part) - 1).alias("worst_drawdown"))


def risk_scores(
    metrics: DataFrame,
    alerts: DataFrame,
    order: Sequence[str] = ("timestamp",),
    policy: SplitPolicy = DEFAULT_POLICY,
    keys: DataFrame | None = None,
) -> DataFrame:
    """Score, band and parts per key, for keys with metrics or alerts in the frames.

    With ``keys``, for just those, whether or not they have any rows.
    """
    spread = metrics.groupBy("id").agg(
        F.count(F.lit(1)).alias("points"),
        F.avg("volatility").alias("avg_volatility"),
        F.stddev_pop("change_5min").alias("std_change_5min"),
    )
    alerted = alerts.groupBy(F.col("coin_id").alias("id")).agg(
        F.count(F.lit(1)).alias("alerts_count")
    )
    parts = (
        spread.join(drawdown(metrics, order, policy), "id", "left")
        .join(anomaly_count(metrics, policy=policy), "id", "left")
        .join(alerted, "id", "full_outer")
    )
    if keys is not None:
        parts = keys.join(parts, "id", "left")
    vol, std, fall, alert_n, anomaly_n = (
        zero_if_null(F.col(name))
        for name in (
            "avg_volatility",
            "std_change_5min",
            "worst_drawdown",
            "alerts_count",
            "anomaly_count",
        )
    )
    raw = clamp(
        at_most(vol * VOLATILITY["weight"], VOLATILITY["ceiling"])
        + at_most(std * MOVE["weight"], MOVE["ceiling"])
        + at_most(F.abs(fall) * 100.0 * DRAWDOWN["weight"], DRAWDOWN["ceiling"])
        + at_most(
            alert_n * SIGNALS["alert"] + anomaly_n * SIGNALS["anomaly"], SIGNALS["ceiling"]
        ),
        0.0,
        100.0,
    )
    band = (
        F.when(F.col("_raw") >= BANDS["HIGH"], "HIGH")
        .when(F.col("_raw") >= BANDS["MEDIUM"], "MEDIUM")
        .otherwise(LOWEST_BAND)
    )
    return parts.withColumn("_raw", raw).select(
        F.col("id").alias("coin_id"),
        F.coalesce("points", F.lit(0)).alias("points"),
        round_half_up(F.col("_raw"), 2).alias("risk_score"),
        band.alias("risk_band"),
        round_half_up(vol, 6).alias("avg_volatility"),
        round_half_up(std, 6).alias("std_change_5min"),
        round_half_up(fall * 100.0, 4).alias("worst_drawdown_pct"),
        alert_n.cast("long").alias("alerts_count"),
        anomaly_n.cast("long").alias("anomaly_count"),
    )
