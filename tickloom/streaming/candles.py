"""Candles of a stream of ticks, and the candles that late ticks amend.

The stream writes a candle once, when the watermark has passed the end of its bucket, and
keeps state for open buckets only. A tick that comes later than that can't change it any more,
but the lake holds it all the same. Candles that would be others with it are computed again
from the lake and kept in a table of their own.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tickloom import schemas
from tickloom.functions.clock import DATE_PARTITION, bucket, instant, since
from tickloom.operators.candles import ends
from tickloom.streaming.ingest import _trigger

CANDLE_KEY = ("id", "symbol", "timestamp")


def _per_bucket(ticks: DataFrame, start: Column, order: Sequence[str]) -> DataFrame:
    opening, closing = ends(order)
    return ticks.groupBy("id", "symbol", start.alias("_bucket")).agg(
        opening.alias("open"),
        F.max("price").alias("high"),
        F.min("price").alias("low"),
        closing.alias("close"),
    )


def _spec(width: timedelta) -> str:
    return f"{int(width.total_seconds())} seconds"


def closed_candles(
    ticks: DataFrame,
    width: timedelta = timedelta(minutes=1),
    order: Sequence[str] = ("timestamp",),
    late: str = "10 minutes",
) -> DataFrame:
    """Candles of a stream whose newest tick is ``late`` past their end."""
    timed = ticks.withColumn("_at", F.col("timestamp").cast("timestamp")).withWatermark("_at", late)
    rows = _per_bucket(timed, F.window("_at", _spec(width)), order)
    start = F.col("_bucket.start").cast("timestamp_ntz")
    return rows.withColumn("timestamp", start).select(
        *schemas.CANDLE_COLUMNS, F.to_date("timestamp").alias(DATE_PARTITION)
    )


def start_candles(
    ticks: DataFrame,
    path: str,
    checkpoint: str,
    width: timedelta = timedelta(minutes=1),
    order: Sequence[str] = ("timestamp",),
    late: str = "10 minutes",
    backfill: bool = False,
) -> StreamingQuery:
    """Append closed candles by date; a stream that is run again continues at its checkpoint."""
    return (
        closed_candles(ticks, width, order, late)
        .writeStream.queryName("candles")
        .format("parquet")
        .outputMode("append")
        .partitionBy(DATE_PARTITION)
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**_trigger(backfill))
        .start()
    )


def _same(left: DataFrame, right: DataFrame, columns: Sequence[str]) -> Column:
    return reduce(Column.__and__, (left[c].eqNullSafe(right[c]) for c in columns))


def amendments(
    ticks: DataFrame,
    candles: DataFrame,
    width: timedelta = timedelta(minutes=1),
    order: Sequence[str] = ("timestamp",),
    start: datetime | None = None,
) -> DataFrame:
    """Candles of closed buckets as all of ``ticks`` make them, where ``candles`` differ or lack.

    ``start``, on a bucket's edge, bounds how far back ticks and candles are read. Buckets up
    to the newest one written are closed; a later bucket whose ticks were all late is found
    once a candle after it is written. ``order`` should settle equal times.
    """
    if start is not None:
        ticks, candles = since(ticks, start), since(candles, start)
    newest = candles.agg(F.max("timestamp")).first()[0]  # one value, which the scan of ticks can use
    if newest is None:
        return ticks.sparkSession.createDataFrame([], schemas.CANDLES)
    closed = ticks.filter(F.col("timestamp") < instant(newest + width))
    if DATE_PARTITION in closed.columns:
        closed = closed.filter(F.col(DATE_PARTITION) <= F.lit((newest + width).date()))
    rows = _per_bucket(closed, bucket(F.col("timestamp"), _spec(width)), order)
    rows = rows.withColumnRenamed("_bucket", "timestamp").select(*schemas.CANDLE_COLUMNS)
    known = candles.select(*schemas.CANDLE_COLUMNS)
    same = _same(rows, known, schemas.CANDLE_COLUMNS)
    return rows.join(known, same, "left_anti")


def amended(candles: DataFrame, amendments: DataFrame) -> DataFrame:
    """Candles with the amended ones in the place of theirs."""
    stored, later = (rows.select(*schemas.CANDLE_COLUMNS) for rows in (candles, amendments))
    return stored.join(later, _same(stored, later, CANDLE_KEY), "left_anti").unionByName(later)
