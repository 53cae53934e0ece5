"""Reads of the tick lake and of the served tables, and parameterised SQL over them."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.functions.clock import DATE_PARTITION, recent

TICK_COLUMNS = ("timestamp", "id", "symbol", "price")


def scan_ticks(spark: SparkSession, path: str, *extra: str) -> DataFrame:
    """The columns the features need, typed; the date partition stays for pruning."""
    lake = spark.read.parquet(path)
    partition = [DATE_PARTITION] if DATE_PARTITION in lake.columns else []
    ticks = lake.select(*TICK_COLUMNS, *extra, *partition)
    if isinstance(ticks.schema["timestamp"].dataType, T.StringType):
        # a lake written with text times; such scans cannot push the time bound down
        ticks = ticks.withColumn(
            "timestamp", F.try_to_timestamp("timestamp").cast("timestamp_ntz")
        )
    if not isinstance(ticks.schema["price"].dataType, T.DoubleType):
        ticks = ticks.withColumn("price", F.col("price").try_cast("double"))
    return ticks


def recent_ticks(spark: SparkSession, path: str, as_of: datetime, minutes: int) -> DataFrame:
    return recent(scan_ticks(spark, path), as_of, minutes)


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A served table; its date partition comes along."""
    partitioned = T.StructType([*schema.fields, T.StructField(DATE_PARTITION, T.DateType())])
    return spark.read.schema(partitioned).parquet(path)


def register(tables: Mapping[str, DataFrame]) -> None:
    """Make frames visible to :func:`query` under their names."""
    for name, frame in tables.items():
        frame.createOrReplaceTempView(name)


def query(spark: SparkSession, sql: str, args: Mapping[str, Any] | None = None) -> DataFrame:
    """Rows of a statement over registered tables, values bound by name."""
    return spark.sql(sql, args=dict(args or {}))


def query_one(spark: SparkSession, sql: str, args: Mapping[str, Any] | None = None) -> DataFrame:
    """The first row only."""
    return query(spark, sql, args).limit(1)


