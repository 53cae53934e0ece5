from __future__ import annotations

from datetime import timedelta

import pytest

from tests.data import at, rows_of, ticks
from tickloom import schemas
from tickloom.plans import analytics_run
from tickloom.session import scratch, shared_folder
from tickloom.settings import Settings
from tickloom.sinks import files, tables
from tickloom.sources import lake, messages
from tickloom.streaming import ingest
from tickloom.streaming.snapshots import start_market_snapshots

DAY = 24 * 60


def metrics(spark, *rows):
    full = [(at(m), k, s, p, None, c, 1.0, 1.0, None) for m, k, s, p, c in rows]
    return spark.createDataFrame(full, schemas.METRICS)


def stored(spark, path, schema=schemas.METRICS):
    return tables.read_table(spark, path, schema)


def test_upsert_replaces_values_but_not_the_symbol(spark):
    path = scratch(spark, "t")
    tables.upsert(metrics(spark, (0, "a", "A", 1.0, 5.0), (DAY, "a", "A", 2.0, 5.0)), path, schemas.METRICS)
    new = metrics(spark, (0, "a", "Z", 9.0, None), (0, "b", "B", 3.0, 1.0))
    for _ in range(2):
        tables.upsert(new, path, schemas.METRICS)
    got = rows_of(stored(spark, path).orderBy("timestamp", "id"), "id", "symbol", "price", "change_5min")
    assert got == [("a", "A", 9.0, None), ("b", "B", 3.0, 1.0), ("a", "A", 2.0, 5.0)]


def test_upsert_leaves_other_dates_alone(spark):
    path = scratch(spark, "t")
    tables.upsert(metrics(spark, (0, "a", "A", 1.0, 5.0), (DAY, "a", "A", 2.0, 5.0)), path, schemas.METRICS)
    files_of = lambda: rows_of(
        spark.read.parquet(path).filter("dt = '2024-01-02'").select("_metadata.file_path")
    )
    before = files_of()
    tables.upsert(metrics(spark, (1, "a", "A", 1.0, 5.0)), path, schemas.METRICS)
    assert files_of() == before
    assert stored(spark, path).count() == 3


def test_upsert_keeps_rows_without_a_time(spark):
    path = scratch(spark, "t")
    row = lambda time, key, price: (time, key, key.upper(), price, None, None, 1.0, 1.0, None)
    frame = lambda *rows: spark.createDataFrame(list(rows), schemas.METRICS)
    tables.upsert(frame(row(None, "x", 1.0), row(at(0), "y", 1.0)), path, schemas.METRICS)
    for _ in range(2):
        tables.upsert(frame(row(None, "z", 2.0), row(at(DAY), "y", 2.0)), path, schemas.METRICS)
        tables.insert_ignore(frame(row(None, "w", 3.0), row(None, "z", 3.0)), path, schemas.METRICS)
    got = sorted(rows_of(stored(spark, path), "id", "price"))
    assert got == [("w", 3.0), ("x", 1.0), ("y", 1.0), ("y", 2.0), ("z", 2.0)]


def test_insert_ignore_keeps_stored_rows_and_may_run_twice(spark):
    path = scratch(spark, "t")
    candle = lambda m, o: ("a", "A", at(m), o, o, o, o)
    tables.insert_ignore(spark.createDataFrame([candle(0, 1.0)], schemas.CANDLES), path, schemas.CANDLES)
    new = spark.createDataFrame([candle(0, 9.0), candle(1, 2.0), candle(1, 2.0)], schemas.CANDLES)
    for _ in range(2):
        tables.insert_ignore(new, path, schemas.CANDLES)
    assert sorted(rows_of(stored(spark, path, schemas.CANDLES), "open")) == [(1.0,), (2.0,)]


def test_compaction_sorts_closed_dates_into_few_files(spark):
    path = scratch(spark, "t")
    for n in range(4):
        rows = metrics(spark, *((m, f"k{m * 7 % 5}", "S", float(n), 0.0) for m in (n, n + 9, DAY + n)))
        tables.append(rows.repartition(2), path, "timestamp")
    before = sorted(map(repr, rows_of(stored(spark, path))))
    files_of = lambda date: {
        r[0] for r in spark.read.parquet(path).filter(f"dt = '{date}'").select("_metadata.file_path").collect()
    }
    first, second = (str(at(m).date()) for m in (0, DAY))
    still_open = files_of(second)
    for _ in range(2):
        tables.compact(spark, path, schemas.METRICS, at(DAY).date())
    assert sorted(map(repr, rows_of(stored(spark, path)))) == before
    assert len(files_of(first)) == 1 and files_of(second) == still_open and len(still_open) > 1
    (name,) = files_of(first)
    got = rows_of(spark.read.parquet(name), "id", "timestamp")
    assert got == sorted(got)


def test_an_empty_snapshot_replaces_a_full_one(spark):
    path = scratch(spark, "s")
    assert tables.current_snapshot(spark, path, schemas.MOVERS).count() == 0
    rows = spark.createDataFrame([(1, "a", "A", 1.0, 2.0)], schemas.MOVERS)
    for run in ("1", "2", "3"):
        tables.replace_snapshot(rows, path, run)
    assert tables.current_snapshot(spark, path, schemas.MOVERS).count() == 1
    tables.replace_snapshot(rows.limit(0), path, "4")
    assert tables.current_snapshot(spark, path, schemas.MOVERS).count() == 0
    assert files.partition_values(spark, path, tables.RUN_PARTITION) == ["3", "4"]


def test_an_unfinished_snapshot_is_not_current(spark):
    path = scratch(spark, "s")
    rows = spark.createDataFrame([(1, "a", "A", 1.0, 2.0)], schemas.MOVERS)
    tables.replace_snapshot(rows, path, "1")
    rows.limit(0).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{path}/{tables.RUN_PARTITION}=2")
    assert tables.current_snapshot(spark, path, schemas.MOVERS).count() == 1


def test_run_ids_are_plain_words(spark):
    with pytest.raises(ValueError):
        tables.append_run(metrics(spark), "unused", "a/b", "timestamp")


def _aged(spark):
    now = at(10 * DAY + 720)
    ages = [timedelta(0), timedelta(days=7), timedelta(days=7, microseconds=1), timedelta(days=7, hours=5), timedelta(days=9)]
    return now, [now - age for age in ages]


def test_retention_is_strict_at_the_bound(spark):
    path = scratch(spark, "t")
    now, times = _aged(spark)
    rows = [(t, "a", "A", 1.0, None, None, None, None, None) for t in times]
    tables.append(spark.createDataFrame(rows, schemas.METRICS), path, "timestamp")
    assert tables.expired(stored(spark, path), "timestamp", now, 7).count() == 3
    assert tables.retain(spark, path, schemas.METRICS, "timestamp", now, 7) == 3
    assert sorted(rows_of(stored(spark, path), "timestamp")) == sorted((t,) for t in times[:2])
    assert tables.retain(spark, path, schemas.METRICS, "timestamp", now, 7) == 0
    assert tables.retain(spark, path + "-none", schemas.METRICS, "timestamp", now, 7) == 0


def test_retention_of_run_folders(spark):
    path = scratch(spark, "a")
    now, times = _aged(spark)
    for i, t in enumerate(times):
        row = [(t, "a", "A", 1.0, 2.0, "PUMP")]
        tables.append_run(spark.createDataFrame(row, schemas.ALERTS), path, f"run-{i}", "alerted_at")
    assert tables.retain(spark, path, schemas.ALERTS, "alerted_at", now, 7, per_run=True) == 3
    assert sorted(rows_of(stored(spark, path, schemas.ALERTS), "alerted_at")) == sorted((t,) for t in times[:2])


def test_a_rerun_replaces_its_own_alerts(spark):
    path = scratch(spark, "a")
    row = lambda p: spark.createDataFrame([(at(0), "a", "A", p, 2.0, "PUMP")], schemas.ALERTS)
    for run, price in (("1", 1.0), ("2", 2.0), ("2", 3.0)):
        tables.append_run(row(price), path, run, "alerted_at")
    assert sorted(rows_of(stored(spark, path, schemas.ALERTS), "price")) == [(1.0,), (3.0,)]


def _envelope(minute, *records):
    body = ", ".join('{"id": "%s", "symbol": "S", "current_price": %s}' % r for r in records)
    return '{"timestamp": "%s", "data": [%s]}' % (at(minute), body)


def _drop(spark, inbox, *texts):
    spark.createDataFrame([(t,) for t in texts], "value string").write.mode("append").text(inbox)


def _stream(spark, inbox, out, marks):
    feed = messages.read_messages(spark, "text", {}, inbox)
    ingest.start_ticks(feed, out, f"{marks}/ticks", backfill=True).awaitTermination()
    ingest.start_rejects(feed, f"{out}-rejects", f"{marks}/rejects", "in", backfill=True).awaitTermination()


def test_stream_equals_batch_and_restarts_add_nothing(spark):
    inbox, out, marks = (scratch(spark, n) for n in ("inbox", "lake", "marks"))
    _drop(spark, inbox, _envelope(0, ("a", 1.5), ("b", -1)), "no json", _envelope(DAY, ("a", 2.5)))
    _stream(spark, inbox, out, marks)
    feed = messages.read_messages(spark, "text", {}, inbox, streaming=False)
    batch = rows_of(ingest.clean_ticks(feed).select("timestamp", "id", "price", "dt"))
    read = lambda: rows_of(spark.read.parquet(out).select("timestamp", "id", "price", "dt"))
    assert sorted(read()) == sorted(batch) == [(at(0), "a", 1.5, at(0).date()), (at(DAY), "a", 2.5, at(DAY).date())]
    letters = lambda: sorted(r.error_message for r in stored(spark, f"{out}-rejects", schemas.DEAD_LETTERS).collect())
    assert letters() == ["Invalid price: -1.0", "Unexpected message format"]

    _stream(spark, inbox, out, marks)
    assert len(read()) == 2 and len(letters()) == 2
    _drop(spark, inbox, _envelope(1, ("c", 3.0)))
    _stream(spark, inbox, out, marks)
    assert len(read()) == 3 and len(letters()) == 2


def test_snapshots_are_published_per_batch(spark):
    source, marks = scratch(spark, "feed"), scratch(spark, "marks")
    ticks(spark, [1.0, 2.0]).write.parquet(source)
    feed = spark.readStream.schema(spark.read.parquet(source).schema).parquet(source)
    served = {
        "metrics": metrics(spark, (0, "a", "A", 1.0, 5.0)),
        "run_metrics": spark.createDataFrame([("r", "t", "success", 1, 1, None, at(0))], schemas.RUN_METRICS),
    }
    seen = {}
    publish = lambda name, frame, number: seen.update({(number, name): frame.count()})
    start_market_snapshots(feed, lambda: served, publish, marks, backfill=True).awaitTermination()
    assert seen == {(0, "stats"): 1, (0, "latest"): 1, (0, "anomalies"): 0, (0, "runs"): 1}
    with pytest.raises(ValueError):
        start_market_snapshots(feed, lambda: served, publish, marks, interval_seconds=1)


def test_text_times_in_a_lake_are_parsed(spark):
    path = scratch(spark, "lake")
    rows = [("2024-01-01 00:00:00", "a", "A", "1.5"), ("soon", "a", "A", "x")]
    spark.createDataFrame(rows, "timestamp string, id string, symbol string, price string").write.parquet(path)
    assert sorted(rows_of(lake.scan_ticks(spark, path)), key=str) == [(None, "a", "A", None), (at(0), "a", "A", 1.5)]


def test_parameterised_query(spark):
    lake.register({"metrics_view": metrics(spark, (0, "a", "A", 1.0, 5.0), (1, "b", "B", 2.0, 5.0))})
    sql = "SELECT id FROM metrics_view WHERE price >= :least ORDER BY id"
    assert rows_of(lake.query(spark, sql, {"least": 2.0})) == [("b",)]
    assert rows_of(lake.query_one(spark, sql, {"least": 0.0})) == [("a",)]


def test_settings_come_from_the_environment():
    given = Settings.from_env({"TICKLOOM_RETENTION_DAYS": "3", "TICKLOOM_ALERT_THRESHOLD_PCT": "1.5"})
    assert (given.retention_days, given.alert_threshold_pct, given.top_k) == (3, 1.5, 5)
    assert given.spark_conf() == {}
    with pytest.raises(ValueError):
        Settings(object_store_endpoint="x").spark_conf()


def test_shared_folder_is_the_configured_one(spark):
    assert shared_folder(spark) == spark.sparkContext.getConf().get("spark.checkpoint.dir")


def test_analytics_run_end_to_end_and_twice(spark):
    settings = Settings(lake=scratch(spark, "lake"), tables=scratch(spark, "tables"), top_k=2)
    rows = None
    for key, last in (("a", 30.0), ("b", 5.0), ("c", 10.0)):
        series = ticks(spark, [10.0, 10.0, 10.0, 10.0, 10.0, 10.0, last], key).drop("seq")
        rows = series if rows is None else rows.unionByName(series)
    tables.append(rows, settings.lake, "timestamp")
    now = at(8.5)
    for _ in range(2):
        analytics_run.run(spark, settings, now)
    found = analytics_run.known_tables(spark, settings)
    assert rows_of(found["metrics"].orderBy("id"), "id", "change_5min") == [("a", 200.0), ("b", -50.0), ("c", 0.0)]
    # minute 7 holds no tick; minutes 0 to 6 are closed
    assert found["candles"].count() == 21
    assert rows_of(found["gainers"].orderBy("rank"), "id") == [("a",), ("c",)]
    assert rows_of(found["losers"].orderBy("rank"), "id") == [("b",), ("c",)]
    assert sorted(rows_of(found["alerts"], "coin_id", "alert_type")) == [("a", "PUMP"), ("b", "DUMP")]
    assert rows_of(found["run_metrics"], "status") == [("success",), ("success",)]

    # nothing recent: no table changes, but retention still runs
    later = at(9 * DAY)
    removed = analytics_run.run(spark, settings, later)
    assert (removed["metrics"], removed["candles"], removed["alerts"]) == (3, 21, 2)
    assert analytics_run.known_tables(spark, settings)["gainers"].count() == 2


def test_analytics_run_published_together(spark):
    root = scratch(spark, "tables")
    settings = Settings(lake=scratch(spark, "lake"), tables=root, top_k=2, publish_together=1)
    series = [ticks(spark, [10.0] * 6 + [last], key).drop("seq") for key, last in (("a", 30.0), ("b", 5.0), ("c", 10.0))]
    tables.append(series[0].unionByName(series[1]).unionByName(series[2]), settings.lake, "timestamp")
    for _ in range(2):
        analytics_run.run(spark, settings, at(8.5))
    found = analytics_run.published_tables(spark, settings)
    assert rows_of(found["metrics"].orderBy("id"), "id", "change_5min") == [("a", 200.0), ("b", -50.0), ("c", 0.0)]
    assert found["candles"].count() == 21
    assert rows_of(found["gainers"].orderBy("rank"), "id") == [("a",), ("c",)]
    assert sorted(rows_of(found["alerts"], "coin_id", "alert_type")) == [("a", "PUMP"), ("b", "DUMP")]
    kept = analytics_run.known_tables(spark, settings)["latest"]
    assert rows_of(kept.orderBy("id"), "id", "price") == [("a", 30.0), ("b", 5.0), ("c", 10.0)]

    # past retention: the dates and the keys go, the rankings stay
    removed = analytics_run.run(spark, settings, at(9 * DAY))
    found = analytics_run.published_tables(spark, settings)
    assert removed["latest"] == 3 and found["metrics"].isEmpty() and found["candles"].isEmpty()
    assert found["gainers"].count() == 2
