"""One analytics run: recent ticks to metrics, candles, rankings and alerts, then retention."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, datetime, timedelta
from time import monotonic

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom import schemas
from tickloom.functions.clock import utc_now
from tickloom.operators.alerts import price_alerts
from tickloom.operators.candles import recent_candles
from tickloom.operators.features import latest_features
from tickloom.operators.ranking import top_gainers, top_losers
from tickloom.settings import Settings
from tickloom.sinks import tables
from tickloom.sinks.latest import expire_latest, merge_latest, read_latest
from tickloom.sinks.publish import (
    APPEND,
    INSERT,
    REPLACE,
    UPSERT,
    Published,
    expire,
    fold,
    publish,
    read_published,
)
from tickloom.sources.lake import recent_ticks, scan_ticks

# Schema, time column and run folders of each table that retention covers.
RETAINED = {
    "metrics": (schemas.METRICS, "timestamp", False),
    "candles": (schemas.CANDLES, "timestamp", False),
    "alerts": (schemas.ALERTS, "alerted_at", True),
    "run_metrics": (schemas.RUN_METRICS, "created_at", False),
    "dead_letters": (schemas.DEAD_LETTERS, "created_at", True),
}

# Tables that are compacted, with the order of their rows. Tables in run folders keep those.
COMPACTED = {
    "metrics": ("id", "timestamp"),
    "candles": ("id", "timestamp"),
    "run_metrics": ("created_at", "run_id"),
}

# The five results of a run, as they are kept when they are published together.
PUBLISHED = {
    "metrics": Published(schemas.METRICS, UPSERT, keep=("symbol",)),
    "candles": Published(schemas.CANDLES, INSERT),
    "gainers": Published(schemas.MOVERS, REPLACE, None),
    "losers": Published(schemas.MOVERS, REPLACE, None),
    "alerts": Published(schemas.ALERTS, APPEND, "alerted_at"),
}


def run_metric(
    spark: SparkSession,
    run_id: str,
    task: str,
    status: str,
    as_of: datetime,
    records_pushed: int = 0,
    latency_ms: int = 0,
    error_message: str | None = None,
) -> DataFrame:
    """One row for the run metrics table."""
    row = [(run_id, task, status, records_pushed, latency_ms, error_message, as_of)]
    return spark.createDataFrame(row, schemas.RUN_METRICS)


def _write_in_turn(spark: SparkSession, root: str, run_id: str, results: Mapping[str, DataFrame]) -> None:
    """Each result into its own table; readers may see the first before the last."""
    tables.upsert(results["metrics"], f"{root}/metrics", schemas.METRICS)
    tables.insert_ignore(results["candles"], f"{root}/candles", schemas.CANDLES)
    tables.replace_snapshot(results["gainers"], f"{root}/gainers", run_id)
    tables.replace_snapshot(results["losers"], f"{root}/losers", run_id)
    tables.append_run(results["alerts"], f"{root}/alerts", run_id, "alerted_at")


def _write_together(spark: SparkSession, root: str, run_id: str, results: Mapping[str, DataFrame]) -> None:
    """All results in one switch; readers use ``published_tables``."""
    publish(spark, f"{root}/published", run_id, {name: (rows, PUBLISHED[name]) for name, rows in results.items()})
    fold(spark, f"{root}/published", PUBLISHED)


def analyse(
    spark: SparkSession,
    settings: Settings,
    as_of: datetime | None = None,
    order: Sequence[str] = ("timestamp",),
    together: bool = False,
) -> bool:
    """Write all results of the look-back; False if it holds no ticks.

    One clock serves the whole run, so a task that is run again gives the same rows.
    Every result is written by the executors; none passes through the driver. With
    ``together`` the five results become visible at once. The table of latest rows is merged
    last: a run that dies before leaves it as it was, and the rerun makes good for it.
    """
    as_of = utc_now() if as_of is None else as_of
    run_id = f"{as_of:%Y%m%dT%H%M%S}"
    root = settings.tables
    ticks = recent_ticks(spark, settings.lake, as_of, settings.lookback_minutes)
    if ticks.isEmpty():
        return False

    # one row per key, used by four writes
    latest = latest_features(ticks, order).persist(StorageLevel.MEMORY_AND_DISK)
    candles = recent_candles(
        scan_ticks(spark, settings.lake),
        as_of,
        settings.lookback_minutes,
        timedelta(seconds=settings.candle_seconds),
        order,
    )
    results = {
        "metrics": latest,
        "candles": candles,
        "gainers": top_gainers(latest, settings.top_k),
        "losers": top_losers(latest, settings.top_k),
        "alerts": price_alerts(latest, as_of, settings.alert_threshold_pct),
    }
    try:
        (_write_together if together else _write_in_turn)(spark, root, run_id, results)
        merge_latest(latest, f"{root}/latest", schemas.METRICS)
    finally:
        latest.unpersist()
    return True


def retain_all(spark: SparkSession, settings: Settings, as_of: datetime) -> dict[str, int]:
    """Removed rows per table. Runs on its own, also when there are no new ticks."""
    removed = {
        name: tables.retain(
            spark, f"{settings.tables}/{name}", schema, time, as_of, settings.retention_days, per_run
        )
        for name, (schema, time, per_run) in RETAINED.items()
    }
    expire(spark, f"{settings.tables}/published", PUBLISHED, as_of, settings.retention_days)
    path = f"{settings.tables}/latest"
    days = settings.retention_days
    return {**removed, "latest": expire_latest(spark, path, schemas.METRICS, "timestamp", as_of, days)}


def compact_all(spark: SparkSession, settings: Settings, as_of: datetime) -> dict[str, list[date]]:
    """Rewritten dates per table, of those that no look-back reaches any more."""
    before = (as_of - timedelta(minutes=settings.lookback_minutes)).date()
    return {
        name: tables.compact(spark, f"{settings.tables}/{name}", schema, before, COMPACTED[name])
        for name, (schema, _, _) in RETAINED.items()
        if name in COMPACTED
    }


def run(spark: SparkSession, settings: Settings, as_of: datetime | None = None) -> dict[str, int]:
    """Analyse, retain, compact closed dates, and log the outcome as a run metric."""
    as_of = utc_now() if as_of is None else as_of
    run_id = f"{as_of:%Y%m%dT%H%M%S}"
    started = monotonic()

    def log(status: str, error: str | None = None) -> None:
        spent = int((monotonic() - started) * 1000)
        row = run_metric(spark, run_id, "analytics", status, as_of, 0, spent, error)
        tables.append(row, f"{settings.tables}/run_metrics", "created_at")

    try:
        analyse(spark, settings, as_of, together=bool(settings.publish_together))
        removed = retain_all(spark, settings, as_of)
        compact_all(spark, settings, as_of)
    except Exception as failure:
        log("failure", str(failure))
        raise
    log("success")
    return removed


def known_tables(spark: SparkSession, settings: Settings) -> dict[str, DataFrame]:
    """The served tables by name; tables not yet written are empty."""
    found = {}
    for name, (schema, _, _) in RETAINED.items():
        path = f"{settings.tables}/{name}"
        found[name] = (
            tables.read_table(spark, path, schema)
            if tables.has_data(spark, path)
            else spark.createDataFrame([], schema).withColumn("dt", F.lit(None).cast("date"))
        )
    for name in ("gainers", "losers"):
        found[name] = tables.current_snapshot(spark, f"{settings.tables}/{name}", schemas.MOVERS)
    found["latest"] = read_latest(spark, f"{settings.tables}/latest", schemas.METRICS)
    return found


def published_tables(spark: SparkSession, settings: Settings) -> dict[str, DataFrame]:
    """The five results as of the newest run that was published whole."""
    root = f"{settings.tables}/published"
    return {name: read_published(spark, root, name, kept) for name, kept in PUBLISHED.items()}
