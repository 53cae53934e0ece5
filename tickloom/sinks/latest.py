"""A maintained table of the latest row of every key, so that reads of it scan no history.

The table has one row per key and is kept in buckets of keys. A merge reads and rewrites
only the buckets that its rows fall in, so its work follows the keys that changed and
never the rows that were ever stored. Merging is the maximum of an order: late rows change
nothing, rows may come in any sequence, and a merge that is run again leaves the same rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.functions.clock import instant
from tickloom.sinks.files import drop_folder, has_data

BUCKET = "bucket"
BUCKETS = 64
# A key may have had several symbols; the newest row of each stays, for lists of both.
LATEST_KEY = ("id", "symbol")


def _newest(rows: DataFrame, key: Sequence[str], order: Sequence[str], buckets: int) -> DataFrame:
    """One row per key, combined before the shuffle: a key with many rows sends one for each task.

    Nulls in the order count as oldest. Rows equal in the whole order are settled by their
    other columns.
    """
    rest = [c for c in rows.columns if c not in key and c not in order]
    best = F.max(F.struct(*order, *rest)).alias("_best")
    number = F.pmod(F.xxhash64(key[0]), F.lit(buckets)).cast("int").alias(BUCKET)
    picked = rows.groupBy(*key).agg(best)
    names = {c: F.col(c) if c in key else F.col(f"_best.{c}") for c in rows.columns}
    return picked.select(*(column.alias(c) for c, column in names.items()), number)


def _numbers(rows: DataFrame) -> list[int]:
    """Bucket numbers, as many as there are buckets at most."""
    return [r[0] for r in rows.select(BUCKET).distinct().collect()]


def _stored(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(T.StructType([*schema.fields, T.StructField(BUCKET, T.IntegerType())])).parquet(path)


def _replace_buckets(rows: DataFrame, path: str) -> None:
    (
        rows.hint("rebalance", BUCKET)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(BUCKET)
        .parquet(path)
    )


def read_latest(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The table; no rows before the first merge."""
    if not has_data(spark, path):
        return spark.createDataFrame([], schema)
    return _stored(spark, path, schema).drop(BUCKET)


def merge_latest(
    rows: DataFrame,
    path: str,
    schema: T.StructType,
    order: Sequence[str] = ("timestamp",),
    key: Sequence[str] = LATEST_KEY,
    buckets: int = BUCKETS,
) -> None:
    """Keep the newest row of each key among the stored and the given ones.

    The first of ``order`` is the time. At equal times a given row takes the place of the
    stored one, as the newer write. The number of buckets is fixed for a table. Rows are
    evaluated once, and no more is held or written than the keys' buckets.
    """
    spark = rows.sparkSession
    names = schema.fieldNames()
    run = "_given"
    given = _newest(rows.select(*names), key, order, buckets).persist()
    try:
        touched = _numbers(given)
        if not touched:
            return
        merged = given
        if has_data(spark, path):
            old = _stored(spark, path, schema).filter(F.col(BUCKET).isin(touched)).drop(BUCKET)
            both = old.withColumn(run, F.lit(0)).unionByName(given.drop(BUCKET).withColumn(run, F.lit(1)))
            merged = _newest(both, key, [*order, run], buckets).drop(run)
        _replace_buckets(merged, path)
    finally:
        given.unpersist()


def expire_latest(
    spark: SparkSession, path: str, schema: T.StructType, time: str, as_of: datetime, days: int
) -> int:
    """Drop keys whose newest row is past retention, and say how many; null times stay.

    Since a key's other rows are older, the table then equals the latest rows of what is kept.
    """
    if not has_data(spark, path):
        return 0
    table = _stored(spark, path, schema)
    old = F.coalesce(F.col(time) < instant(as_of - timedelta(days=days)), F.lit(False))
    # one row for each bucket
    split = table.groupBy(BUCKET).agg(F.count_if(old).alias("old"), F.count_if(~old).alias("kept")).filter("old > 0").collect()
    mixed = [r[BUCKET] for r in split if r["kept"]]
    if mixed:
        _replace_buckets(table.filter(F.col(BUCKET).isin(mixed)).filter(~old), path)
    for r in split:
        if not r["kept"]:
            drop_folder(spark, f"{path}/{BUCKET}={r[BUCKET]}")
    return sum(r["old"] for r in split)
