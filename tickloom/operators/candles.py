"""Open, high, low and close per key and time bucket."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions.clock import bucket, instant, since
from tickloom.schemas import CANDLE_COLUMNS


def ends(order: Sequence[str]) -> tuple[Column, Column]:
    """The first and the last price by ``order``, as aggregates."""
    moment = F.struct(*order) if len(order) > 1 else F.col(order[0])
    return F.min_by("price", moment), F.max_by("price", moment)


def candles(
    ticks: DataFrame,
    width: timedelta = timedelta(minutes=1),
    order: Sequence[str] = ("timestamp",),
    as_of: datetime | None = None,
) -> DataFrame:
    """Candles of ``width``; with ``as_of``, only buckets closed for one width.

    Both ends of a candle come from one aggregate, combined before the shuffle, so
    a busy key or minute costs one row per input split.
    """
    opening, closing = ends(order)
    spec = f"{int(width.total_seconds())} seconds"
    rows = (
        ticks.withColumn("_bucket", bucket(F.col("timestamp"), spec))
        .groupBy("id", "symbol", "_bucket")
        .agg(
            opening.alias("open"),
            F.max("price").alias("high"),
            F.min("price").alias("low"),
            closing.alias("close"),
        )
        .withColumnRenamed("_bucket", "timestamp")
    )
    if as_of is not None:
        rows = rows.filter(F.col("timestamp") < instant(as_of - width))
    return rows.select(*CANDLE_COLUMNS)


def recent_candles(
    ticks: DataFrame,
    as_of: datetime,
    minutes: int,
    width: timedelta = timedelta(minutes=1),
    order: Sequence[str] = ("timestamp",),
) -> DataFrame:
    """Closed candles of the look-back, whose lower end is moved to a bucket edge.

    A look-back that starts inside a bucket would give a first candle that lacks its
    opening rows, and stored candles are never amended.
    """
    start = as_of - timedelta(minutes=minutes)
    edge = datetime(1970, 1, 1) + ((start - datetime(1970, 1, 1)) // width) * width
    return candles(since(ticks, edge), width, order, as_of)
