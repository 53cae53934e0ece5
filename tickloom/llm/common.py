"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tickloom.session import written

# A word is a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(columns: Iterable[str], name: str) -> str:
    """A column name that the frame does not have; Spark ignores case in names."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def word_count(text: Column) -> Column:
    """Number of words in a text, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def running(frame: DataFrame, order: list[str], sums: dict[str, Column], name: str) -> DataFrame:
    """Adds, for each entry of ``sums``, its sum over all earlier rows in the order.

    A window over the whole table would put it into one task. Here the rows are dealt
    by ranges of the order, written, and summed inside each range; the ranges' totals,
    one row for each, are small and give every range its offset. Nulls come first.
    Rows that tie in the whole order may stand either way.
    """
    part, at = fresh(frame.columns, "_part"), fresh(frame.columns, "_at")
    kept = {f"_in_{k}": v.cast("long") for k, v in sums.items()}
    placed = written(
        frame.withColumns(kept)
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumns({part: F.spark_partition_id(), at: F.monotonically_increasing_id()}),
        name,
    )
    earlier = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy(part)
        .agg(*[F.sum(c).alias(c) for c in kept])
        .select(part, *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"_to{c}") for c in kept])
    )
    inside = Window.partitionBy(part).orderBy(at).rowsBetween(Window.unboundedPreceding, -1)
    # one row for each partition of the range exchange
    joined = placed.join(F.broadcast(offsets), part)
    totals = {
        k: F.col(f"_to_in_{k}") + F.coalesce(F.sum(f"_in_{k}").over(inside), F.lit(0)) for k in sums
    }
    return joined.withColumns(totals).select(*frame.columns, *sums)
