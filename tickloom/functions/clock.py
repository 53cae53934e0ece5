"""One explicit clock per run, and the look-back filters that use it."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DATE_PARTITION = "dt"


def utc_now() -> datetime:
    """The clock of a run: read once on the driver, naive, in UTC."""
    return datetime.now(timezone.utc).replace(tzinfo=None)


def instant(moment: datetime) -> Column:
    """A zone-free timestamp literal, so that scans can push comparisons down."""
    if moment.tzinfo is not None:
        moment = moment.astimezone(timezone.utc).replace(tzinfo=None)
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")


def micros(time: Column) -> Column:
    """Microseconds since the epoch (sessions run in UTC)."""
    return F.unix_micros(time.cast("timestamp"))


def since(rows: DataFrame, bound: datetime, time: str = "timestamp") -> DataFrame:
    """Rows at or after ``bound``; also bounds the date partition where there is one."""
    kept = rows.filter(F.col(time) >= instant(bound))
    if DATE_PARTITION in rows.columns:
        kept = kept.filter(F.col(DATE_PARTITION) >= F.lit(bound.date()))
    return kept


def recent(rows: DataFrame, as_of: datetime, minutes: int, time: str = "timestamp") -> DataFrame:
    """Rows of the last ``minutes``, lower end included, no upper end."""
    return since(rows, as_of - timedelta(minutes=minutes), time)


def lag_seconds(as_of: datetime, time: Column) -> Column:
    """Seconds from ``time`` to the clock, with fractions; null for a null time."""
    return (micros(instant(as_of)) - micros(time)) / F.lit(1e6)


def bucket(time: Column, width: str) -> Column:
    """Start of the epoch-aligned bucket of ``width`` that holds ``time``."""
    return F.window(time, width)["start"]
