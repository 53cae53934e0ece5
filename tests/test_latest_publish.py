"""The maintained latest rows, and results of runs that become visible together."""

from __future__ import annotations

import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from tests.data import START, at, rows_of
from tickloom import schemas
from tickloom.operators.ranking import latest_per_key
from tickloom.plans import served
from tickloom.sinks import publish as p
from tickloom.sinks.latest import expire_latest, merge_latest, read_latest

METRICS = schemas.METRICS.simpleString()[7:-1].replace(":", " ")


def metrics(spark, rows):
    """Rows of (minute or null, key, symbol, price)."""
    full = [(None if m is None else at(m), k, s, price, None, None, None, None, None) for m, k, s, price in rows]
    return spark.createDataFrame(full, schemas.METRICS)


def shown(frame):
    return sorted(rows_of(frame, "timestamp", "id", "symbol", "price"), key=str)


def test_merges_in_any_sequence_equal_the_full_computation(spark, tmp_path):
    rng = random.Random(4)
    rows = [(rng.randrange(60), f"k{rng.randrange(9)}", rng.choice("ab"), float(i)) for i in range(120)]
    rows = list({(m, k, s): (m, k, s, x) for m, k, s, x in rows}.values()) + [(None, "none", "a", 1.0), (3, None, "a", 2.0)]
    path = str(tmp_path / "latest")
    for part in (rows[::3], rows[1::3], rows[2::3], rows[::3]):  # late rows, and one run twice
        merge_latest(metrics(spark, part), path, schemas.METRICS, buckets=4)
    table, full = read_latest(spark, path, schemas.METRICS), metrics(spark, rows)
    assert shown(table) == shown(latest_per_key(full, ("id", "symbol")))
    assert shown(served.coin_list(table).selectExpr("null timestamp", "id", "symbol", "0 price")) == shown(
        served.coin_list(full).selectExpr("null timestamp", "id", "symbol", "0 price")
    )
    order = ("timestamp", "symbol")
    assert shown(served.latest_prices(table, order)) == shown(served.latest_prices(full, order))


def test_equal_times_take_the_newer_write_and_empty_input_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "latest")
    assert read_latest(spark, path, schemas.METRICS).collect() == []
    merge_latest(metrics(spark, []), path, schemas.METRICS)
    assert read_latest(spark, path, schemas.METRICS).collect() == []
    merge_latest(metrics(spark, [(5, "a", "A", 9.0)]), path, schemas.METRICS)
    merge_latest(metrics(spark, [(5, "a", "A", 1.0)]), path, schemas.METRICS)
    merge_latest(metrics(spark, []), path, schemas.METRICS)
    assert shown(read_latest(spark, path, schemas.METRICS)) == [(at(5), "a", "A", 1.0)]


def test_only_touched_buckets_are_written(spark, tmp_path):
    path = tmp_path / "latest"
    merge_latest(metrics(spark, [(1, f"k{i}", "s", 1.0) for i in range(64)]), str(path), schemas.METRICS, buckets=8)
    before = {f: f.stat().st_mtime_ns for f in path.rglob("part-*")}
    merge_latest(metrics(spark, [(2, "k7", "s", 2.0)]), str(path), schemas.METRICS, buckets=8)
    after = {f: f.stat().st_mtime_ns for f in path.rglob("part-*")}
    assert len({f.parent for f in set(after) - set(before)}) == 1
    assert len(set(before) & set(after)) >= 7


def test_expired_keys_go(spark, tmp_path):
    path = str(tmp_path / "latest")
    rows = [(0, "old", "s", 1.0), (60 * 24 * 9, "new", "s", 2.0), (None, "none", "s", 3.0), (1, "older", "s", 0.0)]
    merge_latest(metrics(spark, rows), path, schemas.METRICS, buckets=2)
    as_of = START + timedelta(days=9)
    assert expire_latest(spark, path, schemas.METRICS, "timestamp", as_of, 7) == 2
    assert expire_latest(spark, path, schemas.METRICS, "timestamp", as_of, 7) == 0
    assert {r.id for r in read_latest(spark, path, schemas.METRICS).collect()} == {"new", "none"}


TABLES = {
    "metrics": p.Published(schemas.METRICS, p.UPSERT, keep=("symbol",)),
    "candles": p.Published(schemas.METRICS, p.INSERT),
    "gainers": p.Published(schemas.METRICS, p.REPLACE, None),
    "losers": p.Published(schemas.METRICS, p.REPLACE, None),
    "alerts": p.Published(schemas.METRICS, p.APPEND),
}


def results(spark, rows):
    return {name: (metrics(spark, rows), kept) for name, kept in TABLES.items()}


def state(spark, root):
    return {name: shown(p.read_published(spark, root, name, kept)) for name, kept in TABLES.items()}


def test_rules(spark, tmp_path):
    root = str(tmp_path)
    assert set(map(tuple, state(spark, root).values())) == {()}
    p.publish(spark, root, "r1", results(spark, [(1, "a", "A", 1.0), (2, "b", "B", 1.0), (None, "n", "N", 1.0)]))
    p.publish(spark, root, "r2", results(spark, [(1, "a", "A*", 2.0), (None, "n", "N*", 2.0), (None, "n", "N*", 0.0)]))
    got = state(spark, root)
    assert got["metrics"] == shown(metrics(spark, [(1, "a", "A", 2.0), (2, "b", "B", 1.0), (None, "n", "N", 2.0)]))
    assert got["candles"] == shown(metrics(spark, [(1, "a", "A", 1.0), (2, "b", "B", 1.0), (None, "n", "N", 1.0)]))
    assert got["gainers"] == shown(metrics(spark, [(1, "a", "A*", 2.0), (None, "n", "N*", 2.0), (None, "n", "N*", 0.0)]))
    assert len(got["alerts"]) == 6


def test_a_run_that_dies_between_two_writes_changes_nothing(spark, tmp_path):
    root = str(tmp_path)
    p.publish(spark, root, "r1", results(spark, [(1, "a", "A", 1.0)]))
    before = state(spark, root)
    for survivors in range(5):
        half = results(spark, [(1, "a", "A", 5.0), (9, "z", "Z", 5.0)])
        name = list(half)[survivors]
        broken = half[name][0].withColumn("price", F.raise_error(F.lit("lost")).cast("double"))
        with pytest.raises(Exception, match="lost"):
            p.publish(spark, root, "r2", {**half, name: (broken, half[name][1])})
        assert state(spark, root) == before
    for _ in range(2):  # the rerun, and a rerun of what is published already
        p.publish(spark, root, "r2", results(spark, [(1, "a", "A", 5.0), (9, "z", "Z", 5.0)]))
        after = state(spark, root)
        assert all((at(9), "z", "Z", 5.0) in rows for rows in after.values()) and len(after["alerts"]) == 3


def test_manifest_without_success_mark_is_not_seen(spark, tmp_path):
    root = str(tmp_path)
    p.publish(spark, root, "r1", results(spark, [(1, "a", "A", 1.0)]))
    before = state(spark, root)
    p.publish(spark, root, "r2", results(spark, [(1, "a", "A", 2.0)]))
    newest = sorted((tmp_path / p.MANIFESTS).iterdir())[-1]
    (newest / "_SUCCESS").unlink()
    assert state(spark, root) == before
    p.publish(spark, root, "r3", results(spark, [(3, "c", "C", 1.0)]))
    assert len(state(spark, root)["alerts"]) == 2


def test_what_a_run_writes_does_not_grow_with_its_date(spark, tmp_path):
    def written_by(name, run, rows):
        before = {f for f in tmp_path.rglob("*.parquet")}
        p.publish(spark, str(tmp_path), run, {name: (metrics(spark, rows), TABLES["metrics"])})
        return sum(f.stat().st_size for f in set(tmp_path.rglob("*.parquet")) - before if p.MANIFESTS not in str(f))

    written_by("large", "r0", [(i / 60, f"k{i}", "S", float(i)) for i in range(5000)])
    assert written_by("large", "r1", [(1, "x", "S", 1.0)]) <= 1.2 * written_by("small", "r1", [(1, "x", "S", 1.0)])


def test_folding_keeps_all_rows_and_a_second_call_writes_nothing(spark, tmp_path):
    root = str(tmp_path)
    for i in range(5):
        p.publish(spark, root, f"r{i}", results(spark, [(1, "a", f"A{i}", float(i)), (i + 2, "b", "B", 1.0)]))
    before = state(spark, root)
    assert p.fold(spark, root, TABLES, most=3) == ["metrics", "candles", "alerts"]
    assert state(spark, root) == before
    files = set(tmp_path.rglob("*"))
    assert p.fold(spark, root, TABLES, most=3) == [] and set(tmp_path.rglob("*")) == files
    p.publish(spark, root, "r9", results(spark, [(1, "a", "A9", 9.0)]))
    assert (at(1), "a", "A0", 9.0) in state(spark, root)["metrics"]
    assert (at(1), "a", "A0", 0.0) in state(spark, root)["candles"]


def test_reading_one_key_or_date_reaches_the_scans(spark, tmp_path):
    p.publish(spark, str(tmp_path), "r1", results(spark, [(1, "a", "A", 1.0)]))
    rows = p.read_published(spark, str(tmp_path), "metrics", TABLES["metrics"])
    plan = rows.filter((F.col("dt") == F.lit(START.date())) & (F.col("id") == "a"))._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan and "EqualTo(id,a)" in plan
