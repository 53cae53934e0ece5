"""Run a registered query and its SQL on the same tables and compare all values."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb


def connect(sf_dir: str):
    con = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value + 0.0
    return value


def spark_rows(frame):
    columns = sorted(frame.columns)
    return columns, Counter(
        tuple(_plain(row[c]) for c in columns) for row in frame.select(*columns).collect()
    )


def sql_rows(con, sql: str):
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    columns = sorted(names)
    at = [names.index(c) for c in columns]
    return columns, Counter(tuple(_plain(row[i]) for i in at) for row in cursor.fetchall())


def difference(frame, con, sql: str) -> str | None:
    """What differs, or None."""
    columns, got = spark_rows(frame)
    expected_columns, expected = sql_rows(con, sql)
    if columns != expected_columns:
        return f"columns {columns} != {expected_columns}"
    if got == expected:
        return None
    extra, lacking = got - expected, expected - got
    return (
        f"{columns}: {sum(got.values())} rows against {sum(expected.values())}; "
        f"only here {list(extra)[:3]}; only there {list(lacking)[:3]}"
    )
