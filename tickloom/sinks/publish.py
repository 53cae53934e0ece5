"""Results of a run that become visible together, as deltas merged when they are read.

A run writes each of its results to a folder of its own and then, last of all, a manifest
that names every table's folders. Readers resolve the newest finished manifest and see
nothing else, so a run that dies between two writes leaves all tables as they were, and its
rerun writes the same folders again. What a run writes depends on its own rows only, not on
the size of the dates or tables that they fall in; ``fold`` joins old deltas later.

Manifests are numbered, and one writer at a time publishes to a root, as one scheduled run does.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.functions.clock import DATE_PARTITION
from tickloom.sinks.files import drop_folder, exists, has_data, partition_values
from tickloom.sinks.tables import KEY, check_run_id, with_date

MANIFESTS = "_manifests"
VERSION = "version"
DELTA = "_delta"
_ENTRIES = "name string, place int, folder string"

# What rows of several deltas with one key come to.
UPSERT = "upsert"  # the newest delta's row, with the columns of ``keep`` from the oldest
INSERT = "insert"  # the oldest delta's row
APPEND = "append"  # all rows
REPLACE = "replace"  # the newest delta is the table


@dataclass(frozen=True)
class Published:
    """How a table is kept: its schema, its rule, and its key and time if the rule needs them.

    ``order`` settles rows of one delta that are equal in the key: the largest is kept.
    """

    schema: T.StructType
    rule: str
    time: str | None = "timestamp"
    key: Sequence[str] = KEY
    keep: Sequence[str] = ()
    order: Sequence[str] = ()


def _versions(spark: SparkSession, root: str) -> list[str]:
    """Finished manifests, oldest first."""
    found = partition_values(spark, f"{root}/{MANIFESTS}", VERSION)
    return [v for v in found if exists(spark, f"{root}/{MANIFESTS}/{VERSION}={v}/_SUCCESS")]


def _entries(spark: SparkSession, root: str, version: str) -> dict[str, list[str]]:
    """Folders of each table in a manifest, oldest first: as many as there are unfolded runs."""
    folders: dict[str, list[str]] = {}
    rows = spark.read.schema(_ENTRIES).parquet(f"{root}/{MANIFESTS}/{VERSION}={version}")
    for row in rows.orderBy("name", "place").collect():
        folders.setdefault(row["name"], []).append(row["folder"])
    return folders


def current(spark: SparkSession, root: str) -> dict[str, list[str]]:
    """Folders of each table as of the newest finished manifest; none before the first."""
    versions = _versions(spark, root)
    return _entries(spark, root, versions[-1]) if versions else {}


def _switch(spark: SparkSession, root: str, folders: Mapping[str, Sequence[str]]) -> None:
    """Write the next manifest; its success mark is what readers wait for."""
    taken = partition_values(spark, f"{root}/{MANIFESTS}", VERSION)
    number = int(taken[-1]) + 1 if taken else 1
    rows = [(name, place, folder) for name, found in folders.items() for place, folder in enumerate(found)]
    frame = spark.createDataFrame(rows, _ENTRIES).coalesce(1)
    frame.write.mode("overwrite").parquet(f"{root}/{MANIFESTS}/{VERSION}={number:012d}")


def _write(rows: DataFrame, kept: Published, path: str) -> None:
    rows = rows.select(*kept.schema.fieldNames())
    if kept.time is None:
        rows.write.mode("overwrite").parquet(path)
    else:
        dated = with_date(rows, kept.time).hint("rebalance", DATE_PARTITION)
        # the folder is the delta's own: what an unfinished try left there goes as a whole
        dated.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(DATE_PARTITION).parquet(path)


def _one_of_key(rows: DataFrame, kept: Published) -> DataFrame:
    """The row of each key that its order makes the largest; all columns settle what is left."""
    rest = [c for c in kept.schema.fieldNames() if c not in kept.key and c not in kept.order]
    best = rows.groupBy(*kept.key).agg(F.max(F.struct(*kept.order, *rest)).alias("_row"))
    return best.select(*(F.col(c) if c in kept.key else F.col(f"_row.{c}").alias(c) for c in kept.schema.fieldNames()))


def publish(spark: SparkSession, root: str, run_id: str, results: Mapping[str, tuple[DataFrame, Published]]) -> None:
    """Write all results of a run, then make them visible at once.

    Each result is evaluated once. A run that is published already is written to a new
    folder and takes its old place, so a rerun repeats nothing.
    """
    check_run_id(run_id)
    known = current(spark, root)
    folders = {name: list(found) for name, found in known.items()}
    for name, (rows, kept) in results.items():
        mine = [f for f in folders.get(name, []) if f.startswith(f"{run_id}.")]
        again = max((int(f.rsplit(".", 1)[1]) for f in mine), default=-1) + 1
        folder = f"{run_id}.{again}"
        keyed = kept.rule in (UPSERT, INSERT)
        _write(_one_of_key(rows, kept) if keyed else rows, kept, f"{root}/{name}/{folder}")
        if kept.rule == REPLACE:
            folders[name] = [folder]
        elif mine:
            folders[name] = [folder if f == mine[-1] else f for f in folders[name] if f not in mine[:-1]]
        else:
            folders[name] = [*folders.get(name, []), folder]
    _switch(spark, root, folders)


def _deltas(spark: SparkSession, root: str, name: str, folders: Sequence[str], kept: Published) -> DataFrame:
    """Rows of a table's deltas with each one's place."""
    fields = [*kept.schema.fields, *([T.StructField(DATE_PARTITION, T.DateType())] if kept.time else [])]
    found = spark.createDataFrame([], T.StructType([*fields, T.StructField(DELTA, T.IntegerType())]))
    for place, folder in enumerate(folders):
        path = f"{root}/{name}/{folder}"
        if has_data(spark, path):
            rows = spark.read.schema(T.StructType(fields)).parquet(path)
            found = found.unionByName(rows.withColumn(DELTA, F.lit(place)))
    return found


def _resolved(rows: DataFrame, kept: Published) -> DataFrame:
    """What the deltas come to under the table's rule; a null in a key equals a null.

    Rows of a key share their date, so a bound on the date reaches the scans. Minima and
    maxima are combined before the shuffle.
    """
    if kept.rule in (APPEND, REPLACE):
        return rows.drop(DELTA)
    extra = [DATE_PARTITION] if kept.time in kept.key else []
    values = [c for c in kept.schema.fieldNames() if c not in kept.key]
    whole = F.struct(DELTA, *values)
    pick = (F.min if kept.rule == INSERT else F.max)(whole).alias("_row")
    first = [F.min(F.struct(DELTA, *kept.keep)).alias("_first")] if kept.keep else []
    merged = rows.groupBy(*kept.key, *extra).agg(pick, *first)
    columns = {c: F.col(f"_first.{c}") if c in kept.keep else F.col(f"_row.{c}") for c in values}
    return merged.select(*((F.col(c) if c in kept.key else columns[c].alias(c)) for c in kept.schema.fieldNames()), *extra)


def read_published(spark: SparkSession, root: str, name: str, kept: Published) -> DataFrame:
    """A table as of the newest finished manifest; no rows before the first."""
    return _resolved(_deltas(spark, root, name, current(spark, root).get(name, []), kept), kept)


def fold(
    spark: SparkSession,
    root: str,
    tables: Mapping[str, Published],
    most: int = 16,
    drop: Callable[[SparkSession, str], None] = drop_folder,
) -> list[str]:
    """Join the deltas of each table that has more than ``most`` of them into one, and name the tables.

    Tables with fewer are left alone, so a second call writes nothing. The joined delta is
    written beside the others and takes their place in one switch. Folders that neither the
    new manifest nor the one before it names go afterwards, and so do older manifests; readers
    of the one before are not disturbed.
    """
    known = current(spark, root)
    folders = {name: list(found) for name, found in known.items()}
    done = []
    for name, kept in tables.items():
        old = folders.get(name, [])
        if len(old) <= most:
            continue
        folder = f"{old[-1].rsplit('.', 1)[0]}-folded.{old[-1].rsplit('.', 1)[1]}"
        joined = _resolved(_deltas(spark, root, name, old, kept), kept)
        _write(joined, kept, f"{root}/{name}/{folder}")
        folders[name] = [folder]
        done.append(name)
    if done:
        _switch(spark, root, folders)
        _sweep(spark, root, drop)
    return done


def expire(spark: SparkSession, root: str, tables: Mapping[str, Published], as_of: datetime, days: int) -> None:
    """Drop the dates before the bound from all deltas, as whole folders.

    Rows of the date that holds the bound stay until it has passed; rows without a time stay.
    """
    edge = (as_of - timedelta(days=days)).date().isoformat()
    for name, folders in current(spark, root).items():
        if name not in tables or tables[name].time is None:
            continue
        for folder in folders:
            path = f"{root}/{name}/{folder}"
            for value in partition_values(spark, path, DATE_PARTITION):
                if value < edge:
                    drop_folder(spark, f"{path}/{DATE_PARTITION}={value}")


def _sweep(spark: SparkSession, root: str, drop: Callable[[SparkSession, str], None]) -> None:
    """Drop manifests before the last two, and the folders that only they name."""
    versions = _versions(spark, root)
    named = [_entries(spark, root, v) for v in versions]
    live = {(name, f) for found in named[-2:] for name, folders in found.items() for f in folders}
    dead = {(name, f) for found in named[:-2] for name, folders in found.items() for f in folders} - live
    for name, folder in sorted(dead):
        drop(spark, f"{root}/{name}/{folder}")
    for version in versions[:-2]:
        drop(spark, f"{root}/{MANIFESTS}/{VERSION}={version}")
