"""The few file-system calls that table maintenance needs, on any Hadoop store."""

from __future__ import annotations

from hashlib import sha256

from pyspark.sql import SparkSession


def _locate(spark: SparkSession, path: str):
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsc.hadoopConfiguration()), location


def exists(spark: SparkSession, path: str) -> bool:
    fs, location = _locate(spark, path)
    return fs.exists(location)


def has_data(spark: SparkSession, path: str) -> bool:
    """Whether the folder holds anything a Parquet read would list."""
    fs, location = _locate(spark, path)
    return fs.exists(location) and any(
        not status.getPath().getName().startswith(("_", "."))
        for status in fs.listStatus(location)
    )


def partition_values(spark: SparkSession, path: str, column: str) -> list[str]:
    """Values of one partition column, from folder names alone."""
    fs, location = _locate(spark, path)
    if not fs.exists(location):
        return []
    names = (status.getPath().getName() for status in fs.listStatus(location))
    return sorted(name.split("=", 1)[1] for name in names if name.startswith(f"{column}="))


def partition_marks(spark: SparkSession, path: str, column: str) -> dict[str, str]:
    """A digest of the data files of each partition, which changes with every write to it.

    Made of file names and sizes alone; the names that Spark gives are never used again.
    """
    fs, _ = _locate(spark, path)
    marks = {}
    for value in partition_values(spark, path, column):
        _, folder = _locate(spark, f"{path}/{column}={value}")
        found = sorted(
            f"{status.getPath().getName()} {status.getLen()}"
            for status in fs.listStatus(folder)
            if not status.getPath().getName().startswith(("_", "."))
        )
        marks[value] = sha256("\n".join(found).encode()).hexdigest()
    return marks


def drop_folder(spark: SparkSession, path: str) -> None:
    fs, location = _locate(spark, path)
    fs.delete(location, True)
