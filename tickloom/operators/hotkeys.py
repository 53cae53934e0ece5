"""Windows and per-key joins that hold when one key owns a large share of all rows.

A window partitioned by key puts a whole key into one task. Here the few keys with
too many rows are cut into time slices: the window runs per (key, slice), and the
rows next to the cuts are worked out again in a second, small window that sees only
the rows around each cut. Results equal those of the plain window, row for row.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tickloom.functions.clock import micros
from tickloom.session import written


@dataclass(frozen=True)
class SplitPolicy:
    """When and how finely keys are cut.

    Every key with more than ``hot_rows`` rows is cut into slices of about ``slice_rows``.
    There are at most 1/hot_rows as many such keys as rows and about 1/slice_rows as many
    slices, which is what bounds the list of keys and cuts that is broadcast.

    Results per key are broadcast to rows if there are at most ``broadcast_rows``.
    """

    hot_rows: int = 4_000_000
    slice_rows: int = 1_000_000
    broadcast_rows: int = 100_000


DEFAULT_POLICY = SplitPolicy()

# Assumed width of a row with a key, a time and a value, as stored.
_ROW_BYTES = 16


def no_key_is_hot(rows: DataFrame, policy: SplitPolicy) -> bool:
    """Whether Spark's size estimate of all rows is that of ``hot_rows`` rows at most.

    Then the plain plan serves and no rows need to be counted. Above it the keys are counted,
    and the plain plan still serves if none is hot; both plans give the same rows.
    """
    size = rows._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return int(str(size)) <= policy.hot_rows * _ROW_BYTES


def hot_keys(
    rows: DataFrame, keys: Sequence[str] = ("id",), policy: SplitPolicy = DEFAULT_POLICY
) -> DataFrame:
    """The keys to cut and into how many pieces.

    One aggregate over the key columns, combined before its shuffle.
    """
    counted = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    return _largest(counted, "_rows", keys, policy)


def _largest(
    counted: DataFrame, rows_column: str, keys: Sequence[str], policy: SplitPolicy
) -> DataFrame:
    pieces = F.ceil(F.col(rows_column) / F.lit(policy.slice_rows))
    hot = counted.filter(F.col(rows_column) > policy.hot_rows)
    return hot.select(*keys, pieces.alias("_pieces"))


def _mark(rows: DataFrame, keys: Sequence[str], hot: DataFrame, how: str = "left") -> DataFrame:
    """Rows with what is known of their key; a null key may be hot like any other."""
    named = hot.withColumnsRenamed({k: f"_hot_{k}" for k in keys})
    same = reduce(Column.__and__, (rows[k].eqNullSafe(named[f"_hot_{k}"]) for k in keys))
    # at most 1/hot_rows as many keys as rows
    return rows.join(F.broadcast(named), same, how).drop(*(f"_hot_{k}" for k in keys))


def time_cuts(
    rows: DataFrame,
    keys: Sequence[str] = ("id",),
    time: str = "timestamp",
    policy: SplitPolicy = DEFAULT_POLICY,
) -> DataFrame | None:
    """The hot keys with the times to cut at, which put about as many rows in each slice.

    None if no key is hot, which one count over the keys tells. The cuts are approximate
    quantiles, so a burst of ticks is cut as finely as its rows need. Where they fall does
    not matter for the results.
    """
    hot = written(hot_keys(rows, keys, policy), "hot-keys")
    most = hot.agg(F.max("_pieces")).first()[0]
    if most is None:
        return None
    steps = max(2, most)
    shares = [i / steps for i in range(1, steps)]
    marked = _mark(rows.select(*keys, micros(F.col(time)).alias("_time")), keys, hot, "inner")
    quantiles = marked.groupBy(*keys, "_pieces").agg(
        F.percentile_approx("_time", shares, 10 * steps + 1000).alias("_quantiles")
    )
    wanted = F.when(F.col("_pieces") > 1, F.sequence(F.lit(1).cast("long"), F.col("_pieces") - 1))
    cuts = F.transform(
        F.coalesce(wanted, F.array().cast("array<bigint>")),
        lambda i: F.get("_quantiles", F.floor(i * steps / F.col("_pieces")).cast("int") - 1),
    )
    return written(quantiles.select(*keys, F.array_distinct(cuts).alias("_cuts")), "cuts")


def _count_cuts(rows: DataFrame, time: Column, steps: int) -> DataFrame:
    """Add ``_slice``: how many cuts lie at or before ``time``, 0 for a null time.

    A binary search with a column per step, so that all steps are generated code.
    """
    found = rows.withColumns({"_slice": F.lit(0), "_time": time})
    for k in reversed(range(steps.bit_length())):
        stride = 1 << k
        further = F.get("_cuts", F.col("_slice") + (stride - 1)) <= F.col("_time")
        found = found.withColumn(
            "_slice", F.when(further, F.col("_slice") + stride).otherwise(F.col("_slice"))
        )
    return found


def with_slices(
    rows: DataFrame, keys: Sequence[str], time: str, cuts: DataFrame, how: str = "left"
) -> DataFrame:
    """Add ``_slice``: the time slice of a hot key's row, null for other keys.

    An inner join leaves the hot keys only.
    """
    steps = (cuts.agg(F.max(F.size("_cuts"))).first()[0] or 0) + 1
    placed = _count_cuts(_mark(rows, keys, cuts, how), micros(F.col(time)), steps)
    hot = F.col("_cuts").isNotNull()
    return placed.select(*rows.columns, F.when(hot, F.col("_slice")).alias("_slice"))


def lookback_window(
    rows: DataFrame,
    order: Sequence[str],
    lookback: int,
    columns: Callable[[WindowSpec], Mapping[str, Column]],
    keys: Sequence[str] = ("id",),
    policy: SplitPolicy = DEFAULT_POLICY,
    cuts: DataFrame | None = None,
) -> DataFrame:
    """Add window columns that read a row and at most ``lookback`` rows before it.

    ``columns`` gets an ordered window and returns the new columns. ``order`` starts
    with the time column; slices are cut on it. Within a slice every row after the
    first ``lookback`` is final. The first ``lookback`` rows take their columns from
    a window over the rows beside the cuts, where their predecessors are adjacent.
    """
    across = Window.partitionBy(*keys).orderBy(*order)
    time = order[0]
    if cuts is None and not no_key_is_hot(rows, policy):
        cuts = time_cuts(rows, keys, time, policy)
    if cuts is None:
        return rows.withColumns(dict(columns(across)))

    within = Window.partitionBy(*keys, "_slice").orderBy(*order)
    position = F.row_number().over(within)

    sliced = with_slices(rows, keys, time, cuts)
    settled = sliced.withColumns({**columns(within), "_pos": position}).filter(
        F.col("_slice").isNull() | (F.col("_pos") > lookback)
    )

    beside_cuts = (
        with_slices(rows, keys, time, cuts, "inner")
        .withColumns(
            {"_pos": position, "_later": F.lead(F.lit(1), lookback).over(within)}
        )
        .filter((F.col("_pos") <= lookback) | F.col("_later").isNull())
        .drop("_later")
    )
    mended = beside_cuts.withColumns(dict(columns(across))).filter(F.col("_pos") <= lookback)
    return settled.unionByName(mended).drop("_slice", "_pos")


def running_max(
    rows: DataFrame,
    order: Sequence[str],
    value: str,
    name: str,
    keys: Sequence[str] = ("id",),
    policy: SplitPolicy = DEFAULT_POLICY,
    cuts: DataFrame | None = None,
) -> DataFrame:
    """Add the largest ``value`` up to each row.

    Slices of hot keys start from the largest value of the slices before them.
    """
    so_far = (Window.unboundedPreceding, Window.currentRow)
    time = order[0]
    if cuts is None and not no_key_is_hot(rows, policy):
        cuts = time_cuts(rows, keys, time, policy)
    if cuts is None:
        whole = Window.partitionBy(*keys).orderBy(*order).rowsBetween(*so_far)
        return rows.withColumn(name, F.max(value).over(whole))

    sliced = with_slices(rows, keys, time, cuts)
    earlier = (
        Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    )
    # one row per slice of a hot key
    carried = (
        with_slices(rows, keys, time, cuts, "inner")
        .groupBy(*keys, "_slice")
        .agg(F.max(value).alias("_top"))
        .select(*keys, "_slice", F.max("_top").over(earlier).alias("_carry"))
    )
    within = Window.partitionBy(*keys, "_slice").orderBy(*order).rowsBetween(*so_far)
    renamed = carried.withColumnsRenamed({k: f"_of_{k}" for k in (*keys, "_slice")})
    same = reduce(
        Column.__and__, (sliced[k].eqNullSafe(renamed[f"_of_{k}"]) for k in (*keys, "_slice"))
    )
    return (
        sliced.join(renamed, same, "left")
        .withColumn(name, F.greatest(F.max(value).over(within), F.col("_carry")))
        .select(*rows.columns, name)
    )


def join_per_key(
    rows: DataFrame,
    per_key: DataFrame,
    rows_column: str,
    keys: Sequence[str] = ("id",),
    policy: SplitPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """Inner join of rows to a frame with one row per key.

    ``rows_column`` of ``per_key`` holds the number of rows of the key. The per-key
    frame is computed first. If it is short it is broadcast and the rows stay where
    they are. If not, rows of hot keys are spread over several join partitions, each
    with a copy of the key's row.
    """
    if no_key_is_hot(rows, policy):
        return rows.join(per_key, list(keys))
    per_key = written(per_key, "per-key")
    if per_key.count() <= policy.broadcast_rows:
        return rows.join(F.broadcast(per_key), list(keys))

    hot = _largest(per_key, rows_column, keys, policy)
    salted = _mark(rows, keys, hot).select(
        *rows.columns,
        F.coalesce(F.pmod(F.xxhash64(*rows.columns), F.col("_pieces")), F.lit(0)).alias("_salt"),
    )
    copies = _mark(per_key, keys, hot).select(
        *per_key.columns,
        F.explode(
            F.sequence(F.lit(0).cast("long"), F.coalesce(F.col("_pieces"), F.lit(1)) - 1)
        ).alias("_salt"),
    )
    return salted.join(copies, [*keys, "_salt"]).drop("_salt")
