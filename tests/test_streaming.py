"""Streams that see messages twice, ticks that come late, and compaction with its ledger."""

from __future__ import annotations

import os
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from tests.data import at, rows_of
from tickloom import schemas
from tickloom.operators.candles import candles
from tickloom.plans.analytics_run import analyse, compact_all
from tickloom.session import scratch
from tickloom.settings import Settings
from tickloom.sinks import tables
from tickloom.sources.messages import envelopes, read_messages
from tickloom.streaming.candles import amended, amendments, start_candles
from tickloom.streaming.ingest import once, start_ticks

TICKS = "timestamp timestamp_ntz, id string, symbol string, price double, seq long"
DAY = 24 * 60


def stream_of(spark, folder, rows):
    frame = spark.createDataFrame(rows, TICKS)
    frame.coalesce(1).write.mode("append").parquet(folder)
    return spark.readStream.schema(frame.schema).parquet(folder)


def landed(spark, ticks, out, checkpoint):
    query = (
        once(ticks, "1 hour")
        .writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return sorted(map(repr, rows_of(spark.read.parquet(out))))


def test_a_tick_lands_once_also_after_a_restart(spark):
    inbox, out, checkpoint = (scratch(spark, n) for n in ("in", "out", "check"))
    one = (at(1), "a", "A", 1.0, 1)
    same_id = (at(2), "a", "A", 1.0, 2)
    same_time = (at(1), "b", "B", 1.0, 3)
    # a null in the key: equal rows are repeats, others are not
    untimed = [(None, "a", "A", p, 4) for p in (1.0, 2.0, 2.0)]
    unnamed = [(at(1), None, s, 1.0, 5) for s in (None, "A", "A")]
    rows = [one, same_id, same_time, *untimed, *unnamed]
    first = landed(spark, stream_of(spark, inbox, [*rows, one]), out, checkpoint)
    assert len(first) == 7
    older = (at(-30 * DAY), "a", "A", 1.0, 6)  # never too late, however old
    again = landed(spark, stream_of(spark, inbox, [*rows, older]), out, checkpoint)
    assert sorted([*first, repr(older)]) == again


def test_a_long_message_lands_whole(spark):
    """A copy of the message in the row of each record would take over 40 GB here."""
    inbox, out, checkpoint = (scratch(spark, n) for n in ("in", "out", "check"))
    quotes = spark.range(20_000).select(
        F.concat(F.lit("k"), "id").alias("id"),
        F.lit("S").alias("symbol"),
        F.lit(1.5).alias("current_price"),
        F.lit(at(0)).alias("timestamp"),
    )
    envelopes(quotes).select("value").write.text(inbox)
    feed = read_messages(spark, "text", {}, inbox)
    start_ticks(feed, out, checkpoint, backfill=True).awaitTermination()
    rows = spark.read.parquet(out)
    assert rows.count() == rows.select("id").distinct().count() == 20_000


def test_streamed_candles_with_their_amendments_equal_the_batch_ones(spark):
    inbox, path, checkpoint = (scratch(spark, n) for n in ("in", "candles", "check"))
    order = ("timestamp", "seq")
    in_time = [(at(m / 2), k, k, float(m % 7), m) for m in range(0, 80) for k in ("a", None) if m not in (20, 21)]
    late = [
        (at(3), "a", "a", 99.0, 500),  # a new high and close of a closed bucket
        (at(3), "a", "a", 0.5, 7),
        (at(10.1), "a", "a", 5.0, 501),  # the only tick of a closed bucket
        (at(39.9), "a", "a", 8.0, 502),  # its bucket is still open
        (None, "a", "a", 1.0, 503),
    ]
    for part in (in_time, late):
        feed = stream_of(spark, inbox, part)
        start_candles(feed, path, checkpoint, order=order, backfill=True).awaitTermination()
    streamed = spark.read.parquet(path)
    everything = spark.read.parquet(inbox)
    closed = [r for r in rows_of(candles(everything, order=order)) if r[2] and r[2] <= at(28)]
    changed = amendments(everything, streamed, order=order)
    assert sorted(r[2] for r in rows_of(changed)) == [at(3), at(10)]
    assert sorted(map(repr, rows_of(amended(streamed, changed)))) == sorted(map(repr, closed))
    bounded = amendments(everything, streamed, order=order, start=at(4))
    assert rows_of(bounded, "timestamp") == [(at(10),)]
    assert amendments(everything, streamed.limit(0), order=order).count() == 0


def metrics(spark, *rows):
    full = [(at(m), k, "S", float(m), None, 0.0, 1.0, 1.0, None) for m, k in rows]
    return spark.createDataFrame(full, schemas.METRICS)


def files_in(path):
    return {f for _, _, names in os.walk(path) for f in names if f.endswith(".parquet") and f.startswith("part-")}


def test_a_second_compaction_writes_nothing_and_late_rows_bring_a_date_back(spark):
    path = scratch(spark, "t")
    for n in range(3):
        tables.append(metrics(spark, (n, "a"), (DAY + n, "b"), (2 * DAY, "c")), path, "timestamp")
    before = at(2 * DAY).date()
    assert tables.compact(spark, path, schemas.METRICS, before) == [at(0).date(), at(DAY).date()]
    kept = files_in(path)
    assert tables.compact(spark, path, schemas.METRICS, before) == []
    assert files_in(path) == kept
    tables.append(metrics(spark, (9, "late")), path, "timestamp")
    assert tables.compact(spark, path, schemas.METRICS, before) == [at(0).date()]
    assert tables.compact(spark, path, schemas.METRICS, before) == []
    rows = tables.read_table(spark, path, schemas.METRICS)
    assert rows.count() == 10 and rows.filter("id = 'late'").count() == 1
    # retention takes dates away; the ledger does not miss them
    tables.retain(spark, path, schemas.METRICS, "timestamp", at(3 * DAY), 2)
    assert tables.compact(spark, path, schemas.METRICS, before) == []
    assert tables.compact(spark, path, schemas.METRICS, at(3 * DAY).date()) == [before]


def test_a_run_that_dies_before_the_ledger_is_done_again(spark, monkeypatch):
    path = scratch(spark, "t")
    tables.append(metrics(spark, (0, "b"), (1, "a")), path, "timestamp")

    def fail(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(tables, "replace_snapshot", fail)
        with pytest.raises(RuntimeError, match="lost"):
            tables.compact(spark, path, schemas.METRICS, at(DAY).date())
    assert tables.compact(spark, path, schemas.METRICS, at(DAY).date()) == [at(0).date()]
    assert tables.read_table(spark, path, schemas.METRICS).count() == 2


def test_the_folder_of_a_stream_is_not_rewritten(spark):
    inbox, out, checkpoint = (scratch(spark, n) for n in ("in", "out", "check"))
    landed(spark, stream_of(spark, inbox, [(at(1), "a", "A", 1.0, 1)]), out, checkpoint)
    with pytest.raises(ValueError, match="written by a stream"):
        tables.compact(spark, out, schemas.METRICS, at(DAY).date())


def test_the_job_compacts_dates_no_look_back_reaches(spark):
    root = scratch(spark, "job")
    settings = Settings(lake=f"{root}/lake", tables=f"{root}/tables")
    for start in (0, DAY):
        rows = [(at(start + m), "a", "A", 1.0 + m, m) for m in range(10)]
        tables.append(spark.createDataFrame(rows, TICKS).drop("seq"), settings.lake, "timestamp")
        assert analyse(spark, settings, at(start + 10))
    early = at(DAY + 5)  # the look-back still reaches the first date
    assert not any(compact_all(spark, settings, early).values())
    done = compact_all(spark, settings, at(DAY) + timedelta(minutes=10))
    assert done["metrics"] == done["candles"] == [at(0).date()] and done["run_metrics"] == []
    assert not any(compact_all(spark, settings, at(DAY) + timedelta(minutes=10)).values())
