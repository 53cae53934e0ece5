"""Writes of the served tables: upsert, insert-if-absent, replace, append, retention.

Tables are Parquet folders partitioned by date (``dt``). A write touches only the
date partitions its rows fall in: dynamic partition overwrite stages the new files
and swaps whole partitions when the job commits, so it may read what it replaces and
a rerun after a lost executor or driver starts from the old partitions.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from datetime import date, datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.functions.clock import DATE_PARTITION, instant, utc_now
from tickloom.sinks.files import drop_folder, exists, has_data, partition_marks, partition_values
from tickloom.sources.lake import read_table

RUN_PARTITION = "batch_id"
KEY = ("id", "timestamp")
LEDGER = "_compacted"
_LEDGER_ROWS = T.StructType([T.StructField(c, T.StringType()) for c in (DATE_PARTITION, "mark")])


def check_run_id(run_id: str) -> None:
    if not re.fullmatch(r"[A-Za-z0-9_.-]+", run_id):
        raise ValueError(f"run id {run_id!r} may hold letters, digits, '_', '.' and '-' only")


def with_date(rows: DataFrame, time: str) -> DataFrame:
    return rows.withColumn(DATE_PARTITION, F.to_date(time))


def _write(rows: DataFrame, path: str, mode: str, partitions: Sequence[str]) -> None:
    """Write by partition; AQE splits large partitions over tasks and joins small ones."""
    (
        rows.hint("rebalance", *partitions)
        .write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partitions)
        .parquet(path)
    )


def _stored(
    path: str, schema: T.StructType, rows: DataFrame, time: str
) -> DataFrame | None:
    """The stored rows of the dates in ``rows``, or None for a table not yet written."""
    spark = rows.sparkSession
    if not has_data(spark, path):
        return None
    # one row per calendar date, so the broadcast is bounded by the days of a table
    dates = rows.select(F.to_date(time).alias("_date")).distinct()
    table = read_table(spark, path, schema)
    dated = table.join(
        F.broadcast(dates), F.col(DATE_PARTITION) == F.col("_date"), "left_semi"
    )
    # rows without a time share a partition of their own, which an equality never finds
    undated = table.filter(F.col(DATE_PARTITION).isNull()).join(
        F.broadcast(dates.filter("_date is null")),
        F.col(DATE_PARTITION).eqNullSafe(F.col("_date")),
        "left_semi",
    )
    return dated.unionByName(undated).drop(DATE_PARTITION)


def _same_key(left: DataFrame, right: DataFrame, key: Sequence[str]) -> Column:
    """Equality of keys in which a null equals a null, so that a rerun finds its own rows."""
    return reduce(Column.__and__, (left[c].eqNullSafe(right[c]) for c in key))


def _one_per_key(rows: DataFrame, key: Sequence[str], newest: Sequence[str]) -> DataFrame:
    """One row per key, settled by ``newest`` so that a rerun keeps the same row."""
    w = Window.partitionBy(*key).orderBy(*(F.col(c).desc_nulls_last() for c in newest))
    return rows.withColumn("_nth", F.row_number().over(w)).filter("_nth = 1").drop("_nth")


def merged(
    stored: DataFrame, incoming: DataFrame, key: Sequence[str], keep: Sequence[str]
) -> DataFrame:
    """Incoming rows over stored ones; columns of ``keep`` stay as stored.

    An incoming null replaces a stored value, as the incoming row is the newer one.
    """
    values = [c for c in incoming.columns if c not in key]
    new = incoming.select(*(F.col(c).alias(f"_new_{c}") for c in key), F.struct(*values).alias("_new"))
    old = stored.select(*key, F.struct(*(c for c in stored.columns if c not in key)).alias("_old"))
    same = reduce(Column.__and__, (F.col(c).eqNullSafe(F.col(f"_new_{c}")) for c in key))

    def pick(name: str):
        first, second = ("_old", "_new") if name in keep else ("_new", "_old")
        return (
            F.when(F.col(first).isNotNull(), F.col(f"{first}.{name}"))
            .otherwise(F.col(f"{second}.{name}"))
            .alias(name)
        )

    both = old.join(new, same, "full_outer")
    keys = {c: F.coalesce(c, f"_new_{c}").alias(c) for c in key}
    return both.select(*(keys[c] if c in key else pick(c) for c in incoming.columns))


def upsert(
    rows: DataFrame,
    path: str,
    schema: T.StructType,
    time: str = "timestamp",
    key: Sequence[str] = KEY,
    keep: Sequence[str] = ("symbol",),
) -> None:
    """Insert rows, or replace the row with the same key except its ``keep`` columns."""
    values = [c for c in schema.fieldNames() if c not in key]
    incoming = _one_per_key(rows.select(*schema.fieldNames()), key, values)
    stored = _stored(path, schema, rows, time)
    result = incoming if stored is None else merged(stored, incoming, key, keep)
    _write(with_date(result, time), path, "overwrite", [DATE_PARTITION])


def insert_ignore(
    rows: DataFrame,
    path: str,
    schema: T.StructType,
    time: str = "timestamp",
    key: Sequence[str] = KEY,
) -> None:
    """Append the rows whose key is not stored yet."""
    values = [c for c in schema.fieldNames() if c not in key]
    incoming = _one_per_key(rows.select(*schema.fieldNames()), key, values)
    stored = _stored(path, schema, rows, time)
    if stored is not None:
        known = stored.select(*key)
        incoming = incoming.join(known, _same_key(incoming, known, key), "left_anti")
    _write(with_date(incoming, time), path, "append", [DATE_PARTITION])


def append_run(rows: DataFrame, path: str, run_id: str, time: str) -> None:
    """Append the rows of one run or batch; a rerun replaces what it wrote before.

    Its id is a plain word, since it names a folder. A rerun is known by its id and
    the dates of its rows, so rows should keep their times.
    """
    check_run_id(run_id)
    tagged = with_date(rows.withColumn(RUN_PARTITION, F.lit(run_id)), time)
    _write(tagged, path, "overwrite", [DATE_PARTITION, RUN_PARTITION])


def append(rows: DataFrame, path: str, time: str) -> None:
    """Plain append by date."""
    _write(with_date(rows, time), path, "append", [DATE_PARTITION])


def compact(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    before: date,
    order: Sequence[str] = KEY,
) -> list[date]:
    """Rewrite the dates before a day as few files, each sorted by ``order``; the dates rewritten.

    Appends leave a file for each task, date and trigger. Sorted files keep the rows of one
    key together, so that the statistics of row groups let a read of one key skip the others.
    Dates on or after ``before`` are left to writers that may still add rows. Partitions are
    swapped as in any other write here.

    A ledger inside the folder names the files of each date as compaction left them. A date is
    rewritten only if its files are others now, so late rows bring it back and a second run
    writes nothing. The ledger follows the data: a run that dies between them writes the same
    rows again. A stream's own folder lists its files in a log and can't be rewritten.
    """
    if not has_data(spark, path):
        return []
    if exists(spark, f"{path}/_spark_metadata"):
        raise ValueError(f"{path} is written by a stream, whose log names its files")
    ledger = f"{path}/{LEDGER}"
    # a row per date
    done = {row[DATE_PARTITION]: row["mark"] for row in current_snapshot(spark, ledger, _LEDGER_ROWS).collect()}
    changed = {
        value
        for value, mark in partition_marks(spark, path, DATE_PARTITION).items()
        if re.fullmatch(r"\d{4}-\d\d-\d\d", value)
        and date.fromisoformat(value) < before
        and done.get(value) != mark
    }
    if not changed:
        return []
    dates = [date.fromisoformat(value) for value in sorted(changed)]
    (
        read_table(spark, path, schema)
        .filter(F.col(DATE_PARTITION).isin(dates))
        .hint("rebalance", DATE_PARTITION)
        .sortWithinPartitions(DATE_PARTITION, *order)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(DATE_PARTITION)
        .parquet(path)
    )
    # a date that was not rewritten keeps its mark, which shows whether it has changed since
    marks = {
        value: mark if value in changed else done[value]
        for value, mark in partition_marks(spark, path, DATE_PARTITION).items()
        if value in changed or value in done
    }
    rows = spark.createDataFrame(sorted(marks.items()), _LEDGER_ROWS).coalesce(1)
    replace_snapshot(rows, ledger, f"{utc_now():%Y%m%dT%H%M%S%f}")
    return dates


def replace_snapshot(rows: DataFrame, path: str, run_id: str) -> None:
    """Write a whole snapshot, empty or not, in its own folder; run ids sort by time.

    Readers go on with the old snapshot until the new folder carries its success
    mark. Older ones then go, except the one that readers may still hold.
    """
    check_run_id(run_id)
    spark = rows.sparkSession
    rows.write.mode("overwrite").parquet(f"{path}/{RUN_PARTITION}={run_id}")
    for old in partition_values(spark, path, RUN_PARTITION)[:-2]:
        drop_folder(spark, f"{path}/{RUN_PARTITION}={old}")


def current_snapshot(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The newest finished snapshot; no rows before the first one."""
    for run in reversed(partition_values(spark, path, RUN_PARTITION)):
        folder = f"{path}/{RUN_PARTITION}={run}"
        if exists(spark, f"{folder}/_SUCCESS"):
            return spark.read.schema(schema).parquet(folder)
    return spark.createDataFrame([], schema)


def expired(table: DataFrame, time: str, as_of: datetime, days: int) -> DataFrame:
    """Rows strictly older than the bound; null times stay."""
    bound = as_of - timedelta(days=days)
    older = table.filter(F.col(time) < instant(bound))
    if DATE_PARTITION in table.columns:
        older = older.filter(F.col(DATE_PARTITION) <= F.lit(bound.date()))
    return older


def _with_run(schema: T.StructType) -> T.StructType:
    if RUN_PARTITION in schema.fieldNames():
        return schema
    return T.StructType([*schema.fields, T.StructField(RUN_PARTITION, T.StringType())])


def retain(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    time: str,
    as_of: datetime,
    days: int,
    per_run: bool = False,
) -> int:
    """Delete expired rows and say how many.

    Dates before the bound go as whole folders. Of the date that holds the bound,
    only the partitions with rows on both sides are rewritten. ``per_run`` tables
    have a folder per run inside each date.
    """
    if not has_data(spark, path):
        return 0
    bound = as_of - timedelta(days=days)
    edge = bound.date().isoformat()
    partitions = [DATE_PARTITION, RUN_PARTITION] if per_run else [DATE_PARTITION]
    table = read_table(spark, path, _with_run(schema) if per_run else schema)
    on_edge = table.filter(F.col(DATE_PARTITION) == F.lit(bound.date()))
    is_old = F.coalesce(F.col(time) < instant(bound), F.lit(False))

    removed = expired(table, time, as_of, days).count()
    # one row per partition of a single date
    split = (
        on_edge.groupBy(*partitions)
        .agg(F.count_if(is_old).alias("old"), F.count_if(~is_old).alias("kept"))
        .filter("old > 0")
        .collect()
    )
    mixed = [row for row in split if row.kept]
    if mixed:
        kept = on_edge.filter(~is_old)
        if per_run:
            kept = kept.filter(F.col(RUN_PARTITION).isin([row[RUN_PARTITION] for row in mixed]))
        _write(kept, path, "overwrite", partitions)
    for row in split:
        if not row.kept:
            tail = f"/{RUN_PARTITION}={row[RUN_PARTITION]}" if per_run else ""
            drop_folder(spark, f"{path}/{DATE_PARTITION}={edge}{tail}")
    for value in partition_values(spark, path, DATE_PARTITION):
        if value < edge:
            drop_folder(spark, f"{path}/{DATE_PARTITION}={value}")
    return removed
