"""Latest row per key, newest rows, top rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(
    rows: DataFrame, keys: Sequence[str] = ("id",), order: Sequence[str] = ("timestamp",), n: int = 1
) -> DataFrame:
    """The last ``n`` rows of each key.

    Spark cuts each input split to ``n`` rows per key before the shuffle.
    """
    w = Window.partitionBy(*keys).orderBy(*(F.col(c).desc_nulls_last() for c in order))
    return rows.withColumn("_nth", F.row_number().over(w)).filter(F.col("_nth") <= n).drop("_nth")


def newest(rows: DataFrame, limit: int, order: Sequence[str]) -> DataFrame:
    """The ``limit`` rows with the largest ``order``, newest first."""
    return rows.orderBy(*(F.col(c).desc_nulls_last() for c in order)).limit(limit)


def top(rows: DataFrame, limit: int, by: Column, ties: Sequence[str] = ("id",)) -> DataFrame:
    """The first ``limit`` rows in the order ``by``."""
    return rows.orderBy(by, *ties).limit(limit)


def ranked_top(rows: DataFrame, k: int, by: Column, ties: Sequence[str] = ("id",)) -> DataFrame:
    """The first ``k`` rows with their rank; the window sees only those ``k`` rows."""
    cut = top(rows, k, by, ties)
    rank = F.row_number().over(Window.orderBy(by, *ties))
    return cut.select(rank.alias("rank"), *cut.columns)


_MOVER_COLUMNS = ("id", "symbol", "price", "change_5min")


def top_gainers(latest: DataFrame, k: int = 5) -> DataFrame:
    """Snapshot ranking: the latest row counts, and a null change drops the key."""
    return _snapshot(latest, k, F.col("change_5min").desc())


def top_losers(latest: DataFrame, k: int = 5) -> DataFrame:
    return _snapshot(latest, k, F.col("change_5min").asc())


def _snapshot(latest: DataFrame, k: int, by: Column) -> DataFrame:
    known = latest.filter(F.col("change_5min").isNotNull()).select(*_MOVER_COLUMNS)
    return ranked_top(known, k, by)
