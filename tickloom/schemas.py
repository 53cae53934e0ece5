"""Declared schemas; nothing is inferred from data."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(*fields: tuple[str, T.DataType], required: tuple[str, ...] = ()) -> T.StructType:
    return T.StructType([T.StructField(n, t, n not in required) for n, t in fields])


_TEXT, _NUM, _LONG, _INT, _TIME = (
    T.StringType(),
    T.DoubleType(),
    T.LongType(),
    T.IntegerType(),
    T.TimestampNTZType(),
)

# Field names and types of the message and table contracts.
QUOTE = _struct(
    ("id", _TEXT),
    ("symbol", _TEXT),
    ("current_price", _NUM),
    ("market_cap", _LONG),
    ("total_volume", _NUM),
    ("high_24h", _NUM),
    ("low_24h", _NUM),
    ("last_updated", _TEXT),
)
ENVELOPE = _struct(("timestamp", _TEXT), ("data", T.ArrayType(QUOTE)))
TICK_RAW = _struct(
    ("timestamp", _TEXT),
    ("id", _TEXT),
    ("symbol", _TEXT),
    ("price", _NUM),
    ("market_cap", _LONG),
    ("total_volume", _NUM),
    ("high_24h", _NUM),
    ("low_24h", _NUM),
    ("last_updated", _TEXT),
)
METRICS = _struct(
    ("timestamp", _TIME),
    ("id", _TEXT),
    ("symbol", _TEXT),
    ("price", _NUM),
    ("change_1min", _NUM),
    ("change_5min", _NUM),
    ("sma", _NUM),
    ("ema", _NUM),
    ("volatility", _NUM),
)
CANDLES = _struct(
    ("id", _TEXT),
    ("symbol", _TEXT),
    ("timestamp", _TIME),
    ("open", _NUM),
    ("high", _NUM),
    ("low", _NUM),
    ("close", _NUM),
)
MOVERS = _struct(
    ("rank", _INT),
    ("id", _TEXT),
    ("symbol", _TEXT),
    ("price", _NUM),
    ("change_5min", _NUM),
    required=("rank",),
)
ALERTS = _struct(
    ("alerted_at", _TIME),
    ("coin_id", _TEXT),
    ("symbol", _TEXT),
    ("price", _NUM),
    ("change_5min", _NUM),
    ("alert_type", _TEXT),
)
RUN_METRICS = _struct(
    ("run_id", _TEXT),
    ("task", _TEXT),
    ("status", _TEXT),
    ("records_pushed", _INT),
    ("latency_ms", _INT),
    ("error_message", _TEXT),
    ("created_at", _TIME),
    required=("run_id", "task", "status"),
)
DEAD_LETTERS = _struct(
    ("run_id", _TEXT),
    ("payload", _TEXT),
    ("error_message", _TEXT),
    ("created_at", _TIME),
    required=("run_id", "error_message"),
)

METRIC_COLUMNS = METRICS.fieldNames()
CANDLE_COLUMNS = CANDLES.fieldNames()
