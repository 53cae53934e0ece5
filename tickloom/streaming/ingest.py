"""Streaming ingest: messages to a date-partitioned tick lake and a reject table.

Two append queries read the same source, each with its own checkpoint. The ticks go through the file sink, whose commit log makes a micro-batch that is run again
after a failure replace, not repeat, its files.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tickloom.functions.clock import DATE_PARTITION
from tickloom.operators.validation import dead_letters, valid_quotes
from tickloom.schemas import DEAD_LETTERS
from tickloom.sinks.tables import KEY, append_run
from tickloom.sources.messages import flatten, typed_ticks, unreadable

# Fixed value: the micro-batch interval.
INTERVAL = "30 seconds"


def _trigger(backfill: bool) -> dict:
    return {"availableNow": True} if backfill else {"processingTime": INTERVAL}


def quotes_of(messages: DataFrame) -> DataFrame:
    """Flattened records under the names the checks use."""
    return flatten(messages).withColumnRenamed("price", "current_price")


def clean_ticks(messages: DataFrame) -> DataFrame:
    """Valid ticks, typed and dated."""
    return typed_ticks(valid_quotes(quotes_of(messages)).withColumnRenamed("current_price", "price"))


def once(ticks: DataFrame, within: str, key: Sequence[str] = KEY) -> DataFrame:
    """Without ticks that arrive again, with an equal ``key``, ``within`` so long of the first.

    The span is counted by the clock of the micro-batches, so that a tick is never too late,
    however old its own time is. State holds the keys of that span and outlives restarts with
    the checkpoint. Of ticks with one key but other values the first to arrive stays, and any
    one of those that come in one micro-batch. Ticks whose key holds a null are repeats only
    if they are equal in all columns.
    """
    whole = reduce(Column.__and__, (F.col(c).isNotNull() for c in key))
    marked = ticks.withColumns(
        {
            "_arrived": F.current_timestamp(),
            "_rest": F.when(~whole, F.to_json(F.struct(*ticks.columns))),
        }
    )
    first = marked.withWatermark("_arrived", within).dropDuplicatesWithinWatermark([*key, "_rest"])
    return first.select(*ticks.columns)


def rejected(messages: DataFrame, run_id: str, as_of: datetime | None = None) -> DataFrame:
    """Unreadable messages and invalid records as dead letters."""
    created = F.current_timestamp().cast("timestamp_ntz") if as_of is None else as_of
    at = F.lit(created) if isinstance(created, datetime) else created
    whole = unreadable(messages).select(
        F.lit(run_id).alias("run_id"),
        "payload",
        "error_message",
        at.cast("timestamp_ntz").alias("created_at"),
    )
    records = dead_letters(quotes_of(messages), run_id, at.cast("timestamp_ntz"))
    return whole.select(*DEAD_LETTERS.fieldNames()).unionByName(records)


def start_ticks(
    messages: DataFrame,
    lake: str,
    checkpoint: str,
    backfill: bool = False,
    repeats_within: str | None = None,
) -> StreamingQuery:
    """Append valid ticks to the lake; ``backfill`` takes what is there and stops.

    With ``repeats_within`` a message that is sent again lands once (see :func:`once`). The
    choice belongs to the checkpoint: one made without it can't be continued with it.
    """
    ticks = clean_ticks(messages)
    if repeats_within is not None:
        ticks = once(ticks, repeats_within)
    return (
        ticks.writeStream.queryName("ticks")
        .format("parquet")
        .outputMode("append")
        .partitionBy(DATE_PARTITION)
        .option("path", lake)
        .option("checkpointLocation", checkpoint)
        .trigger(**_trigger(backfill))
        .start()
    )


def start_rejects(
    messages: DataFrame, table: str, checkpoint: str, run_id: str, backfill: bool = False
) -> StreamingQuery:
    """Append dead letters, each micro-batch as a run of its own.

    A micro-batch that is run again replaces the partitions it wrote before.
    """

    def each(batch: DataFrame, number: int) -> None:
        append_run(rejected(batch, run_id), table, f"{run_id}-{number}", "created_at")

    return (
        messages.writeStream.queryName("rejects")
        .foreachBatch(each)
        .option("checkpointLocation", checkpoint)
        .trigger(**_trigger(backfill))
        .start()
    )
