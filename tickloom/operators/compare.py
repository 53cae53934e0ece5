"""Per-key window statistics and the correlation of key pairs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions.numeric import round_half_up, safe_pct
from tickloom.operators.candles import ends


def series_stats(order: Sequence[str] = ("timestamp",)) -> dict[str, Column]:
    """Aggregates of one price series, all of which combine before a shuffle.

    The net change is null when the first price is null or zero.
    """
    first, last = ends(order)
    return {
        "points": F.count(F.lit(1)),
        "min_price": F.min("price"),
        "max_price": F.max("price"),
        "avg_price": round_half_up(F.avg("price"), 6),
        "avg_change_5min": round_half_up(F.avg("change_5min"), 4),
        "net_change_pct": round_half_up(safe_pct(last - first, first), 4),
    }


def window_stats(metrics: DataFrame, order: Sequence[str] = ("timestamp",)) -> DataFrame:
    stats = {"symbol": F.min("symbol"), **series_stats(order)}
    return metrics.groupBy("id").agg(*(value.alias(name) for name, value in stats.items()))


def listed_keys(rows: DataFrame, ids: Sequence[str] | DataFrame | None) -> DataFrame:
    """Rows of the keys in a list, as a filter the scan can use; a table of keys waits."""
    if ids is None or isinstance(ids, DataFrame):
        return rows
    return rows.filter(F.col("id").isin(list(ids)))


def tabled_keys(per_key: DataFrame, ids: Sequence[str] | DataFrame | None) -> DataFrame:
    """Per-key results for the keys in a table.

    Joining results, not rows, keeps a busy key from filling one join task.
    """
    if not isinstance(ids, DataFrame):
        return per_key
    return per_key.join(ids.select("id"), "id", "left_semi")


def one_key(rows: DataFrame, key: str) -> DataFrame:
    """A single key as a frame, for answers that exist even without rows."""
    return rows.sparkSession.range(1).select(F.lit(key).alias("id"))


def pair_correlations(metrics: DataFrame, ids: Sequence[str]) -> DataFrame:
    """Correlation and overlap of every pair of the listed keys.

    Each time becomes one row with the prices of the listed keys seen at it. Pairs are formed
    inside that row and combined before their shuffle, so no rows are joined, and the plan has
    the same size for any number of keys.
    """
    listed = sorted(set(ids))
    at_once = (
        listed_keys(metrics, listed)
        .filter(F.col("timestamp").isNotNull())
        .groupBy("timestamp", "id")
        .agg(F.max("price").alias("price"))
        .groupBy("timestamp")
        .agg(F.array_sort(F.collect_list(F.struct("id", "price"))).alias("_seen"))
        .filter(F.size("_seen") > 1)
    )
    first = at_once.select("_seen", F.posexplode("_seen").alias("_at", "_a"))
    later = F.slice("_seen", F.col("_at") + 2, F.size("_seen"))
    pairs = first.select("_a", F.explode(later).alias("_b")).select(
        F.col("_a.id").alias("id_a"),
        F.col("_b.id").alias("id_b"),
        F.col("_a.price").alias("a"),
        F.col("_b.price").alias("b"),
    )
    return pairs.groupBy("id_a", "id_b").agg(
        round_half_up(F.corr("a", "b"), 4).alias("corr"),
        F.count(F.lit(1)).alias("overlap_points"),
    )


def top_pair(metrics: DataFrame, ids: Sequence[str]) -> DataFrame:
    """The pair with most common times."""
    return (
        pair_correlations(metrics, ids)
        .orderBy(F.desc("overlap_points"), "id_a", "id_b")
        .limit(1)
    )
