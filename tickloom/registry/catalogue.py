"""Every registered query with its SQL equivalent, side by side."""

from __future__ import annotations

import inspect
from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom import schemas
from tickloom.functions.clock import bucket, recent
from tickloom.functions.numeric import round_half_up
from tickloom.functions.text import key_list
from tickloom.operators import (
    alerts as alert_ops,
    anomalies as anomaly_ops,
    candles as candle_ops,
    compare as compare_ops,
    features as feature_ops,
    quality as quality_ops,
    ranking,
    reconcile,
    risk as risk_ops,
    runs,
    signals,
    validation,
)
from tickloom.operators.hotkeys import SplitPolicy
from tickloom.plans import served
from tickloom.registry import views as v
from tickloom.registry.views import AS_OF, ALL_MINUTES, USER_ORDER, WEEK_MINUTES, rounded, using
from tickloom.session import scratch, written
from tickloom.sinks import publish, tables
from tickloom.sinks.latest import expire_latest, merge_latest, read_latest
from tickloom.sources import lake, messages
from tickloom.streaming import candles as stream_candle_ops, ingest

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

_NOW = f"TIMESTAMP '{AS_OF:%Y-%m-%d %H:%M:%S}'"
_ALL = f"{_NOW} - INTERVAL {ALL_MINUTES} MINUTE"
_WEEK = f"{_NOW} - INTERVAL {WEEK_MINUTES} MINUTE"

# Small enough to cut each of the five dense keys into several slices.
_FINE = SplitPolicy(hot_rows=100, slice_rows=40, broadcast_rows=0)


def query(sql: str | None = None):
    """Register a query under its function's name, with its SQL if there is one."""

    def add(run: Query) -> Query:
        QUERIES[run.__name__] = run
        if sql is not None:
            ORACLES[run.__name__] = sql
        return run

    return add


# --- features -------------------------------------------------------------------


def _shown(metrics: DataFrame, *columns: str) -> DataFrame:
    """Means and deviation at six places, where the last bits depend on summation order."""
    loose = {"sma", "ema", "volatility"}
    return metrics.select(
        *(round_half_up(F.col(c), 6).alias(c) if c in loose else F.col(c) for c in columns)
    )


_R6 = {c: f"{rounded(c, 6)} AS {c}" for c in ("sma", "ema", "volatility")}
_METRICS_OUT = f'"timestamp", id, symbol, price, change_1min, change_5min, {", ".join(_R6.values())}'


@query(f'{using("metrics_user")} SELECT {_METRICS_OUT} FROM metrics_user')
def features(spark, sf_dir):
    return _shown(v.metrics_user(spark, sf_dir), *schemas.METRIC_COLUMNS)


@query(f'{using("metrics_type")} SELECT {_METRICS_OUT} FROM metrics_type')
def features_hot_keys(spark, sf_dir):
    """The same operator where every key is cut into time slices."""
    metrics = feature_ops.features(v.ticks_type(spark, sf_dir), USER_ORDER, _FINE)
    return _shown(metrics, *schemas.METRIC_COLUMNS)


@query(f'{using("metrics_item")} SELECT {_METRICS_OUT} FROM metrics_item')
def features_items(spark, sf_dir):
    metrics = feature_ops.features(v.ticks_item(spark, sf_dir), v.ITEM_ORDER)
    return _shown(metrics, *schemas.METRIC_COLUMNS)


@query(f'{using("metrics_user")} SELECT id, "timestamp", price, change_1min, change_5min FROM metrics_user')
def price_change(spark, sf_dir):
    return v.metrics_user(spark, sf_dir).select(
        "id", "timestamp", "price", "change_1min", "change_5min"
    )


@query(f'{using("metrics_user")} SELECT id, "timestamp", {_R6["sma"]} FROM metrics_user')
def sma(spark, sf_dir):
    return _shown(v.metrics_user(spark, sf_dir), "id", "timestamp", "sma")


@query(f'{using("metrics_user")} SELECT id, "timestamp", {_R6["ema"]} FROM metrics_user')
def ema3(spark, sf_dir):
    return _shown(v.metrics_user(spark, sf_dir), "id", "timestamp", "ema")


@query(f'{using("metrics_user")} SELECT id, "timestamp", {_R6["volatility"]} FROM metrics_user')
def volatility(spark, sf_dir):
    return _shown(v.metrics_user(spark, sf_dir), "id", "timestamp", "volatility")


# --- latest rows, rankings, alerts ----------------------------------------------

_LATEST = """latest AS (
  SELECT * FROM metrics_user QUALIFY row_number() OVER (PARTITION BY id ORDER BY "timestamp" DESC, seq DESC) = 1)"""


def _latest(spark, sf_dir):
    return feature_ops.latest_features(v.ticks_user(spark, sf_dir), USER_ORDER)


@query(f'{using("metrics_user")}, {_LATEST} SELECT {_METRICS_OUT} FROM latest')
def latest_per_coin(spark, sf_dir):
    return _shown(_latest(spark, sf_dir), *schemas.METRIC_COLUMNS)


def _ranked(direction: str) -> str:
    return f"""{using("metrics_user")}, {_LATEST}
  SELECT CAST(row_number() OVER (ORDER BY change_5min {direction}, id) AS INTEGER) AS rank,
         id, symbol, price, change_5min
  FROM latest WHERE change_5min IS NOT NULL QUALIFY rank <= 5"""


@query(_ranked("DESC"))
def top_gainers(spark, sf_dir):
    return ranking.top_gainers(_latest(spark, sf_dir))


@query(_ranked("ASC"))
def top_losers(spark, sf_dir):
    return ranking.top_losers(_latest(spark, sf_dir))


@query(f"""{using("metrics_user")}, {_LATEST}
  SELECT {_NOW} AS alerted_at, id AS coin_id, symbol, price, change_5min,
         CASE WHEN change_5min >= 2.0 THEN 'PUMP' ELSE 'DUMP' END AS alert_type
  FROM latest WHERE change_5min >= 2.0 OR change_5min <= -2.0""")
def price_alerts(spark, sf_dir):
    return alert_ops.price_alerts(_latest(spark, sf_dir), AS_OF, 2.0)


def _alert_history(spark, sf_dir):
    return alert_ops.price_alerts(v.metrics_user(spark, sf_dir), F.col("timestamp"), 2.0)


@query(f"""{using("alerts")}
  SELECT alerted_at, coin_id, symbol, price, change_5min, alert_type FROM alerts
  ORDER BY alerted_at DESC, coin_id DESC LIMIT 50""")
def recent_alerts(spark, sf_dir):
    return served.recent_alerts(_alert_history(spark, sf_dir))


@query(f"""{using("metrics_user")}
  SELECT {_METRICS_OUT} FROM metrics_user WHERE "timestamp" >= {_WEEK}""")
def recent_window(spark, sf_dir):
    return _shown(
        recent(v.metrics_user(spark, sf_dir), AS_OF, WEEK_MINUTES), *schemas.METRIC_COLUMNS
    )


def _movers_sql(direction: str) -> str:
    return f"""{using("metrics_user")}
  SELECT id, symbol, price, change_5min FROM (
    SELECT * FROM metrics_user WHERE "timestamp" >= {_ALL} AND change_5min IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY id ORDER BY "timestamp" DESC, seq DESC) = 1)
  ORDER BY change_5min {direction}, id LIMIT 5"""


def _movers(spark, sf_dir, side):
    wide = inspect.unwrap(served.movers)
    return wide(v.metrics_user(spark, sf_dir), AS_OF, ALL_MINUTES, 5, USER_ORDER)[side]


@query(_movers_sql("DESC"))
def movers(spark, sf_dir):
    return _movers(spark, sf_dir, "gainers")


@query(_movers_sql("ASC"))
def movers_down(spark, sf_dir):
    return _movers(spark, sf_dir, "losers")


# --- candles --------------------------------------------------------------------


def _candles_sql(source: str, moment: str, unit: str) -> str:
    return f"""candles AS (
  SELECT id, symbol, date_trunc('{unit}', "timestamp") AS "timestamp",
         arg_min(price, {moment}) AS open, max(price) AS high, min(price) AS low,
         arg_max(price, {moment}) AS close
  FROM {source} GROUP BY id, symbol, date_trunc('{unit}', "timestamp")
  HAVING date_trunc('{unit}', "timestamp") < {_NOW} - INTERVAL 1 {unit})"""


_HOURLY = _candles_sql("ticks_type", 'struct_pack(a := "timestamp", b := seq)', "HOUR")
_DAILY = _candles_sql(
    "ticks_item",
    'struct_pack(a := "timestamp", b := l_orderkey, c := l_linenumber, d := l_partkey, e := price)',
    "DAY",
)


def _hourly(spark, sf_dir):
    return candle_ops.candles(
        v.ticks_type(spark, sf_dir), timedelta(hours=1), USER_ORDER, as_of=AS_OF
    )


@query(f'{using("ticks_type")}, {_HOURLY} SELECT * FROM candles')
def ohlc(spark, sf_dir):
    return _hourly(spark, sf_dir)


@query(f'{using("ticks_item")}, {_DAILY} SELECT * FROM candles')
def ohlc_items(spark, sf_dir):
    return candle_ops.candles(
        v.ticks_item(spark, sf_dir), timedelta(days=1), v.ITEM_ORDER, as_of=AS_OF
    )


@query(f"""{using("ticks_type")}, {_HOURLY}
  SELECT id, "timestamp", open, high, low, close FROM candles WHERE "timestamp" >= {_ALL}""")
def ohlc_history(spark, sf_dir):
    return inspect.unwrap(served.ohlc_history)(_hourly(spark, sf_dir), AS_OF, ALL_MINUTES)


# --- served reads of one metrics table ------------------------------------------


@query(f'{using("metrics_user")}, {_LATEST} SELECT {_METRICS_OUT} FROM latest')
def latest_prices(spark, sf_dir):
    rows = served.latest_prices(v.metrics_user(spark, sf_dir), USER_ORDER)
    return _shown(rows, *schemas.METRIC_COLUMNS)


@query(f'{using("metrics_user")} SELECT DISTINCT id, symbol FROM metrics_user')
def coin_list(spark, sf_dir):
    return served.coin_list(v.metrics_user(spark, sf_dir))


_HISTORY_OUT = ", ".join(['id, "timestamp", price, change_1min, change_5min', *_R6.values()])


@query(f"""{using("metrics_user")}
  SELECT {_HISTORY_OUT} FROM metrics_user WHERE "timestamp" >= {_ALL}""")
def coin_history(spark, sf_dir):
    wide = inspect.unwrap(served.coin_history)
    rows = wide(v.metrics_user(spark, sf_dir), AS_OF, ALL_MINUTES)
    return _shown(rows, *rows.columns)


_MOMENT = 'struct_pack(a := "timestamp", b := seq)'
_SERIES_STATS = f"""count(*) AS points, min(price) AS min_price, max(price) AS max_price,
    {rounded("avg(price)", 6)} AS avg_price,
    {rounded("avg(change_5min)", 4)} AS avg_change_5min,
    {rounded(f"(arg_max(price, {_MOMENT}) - arg_min(price, {_MOMENT})) / nullif(arg_min(price, {_MOMENT}), 0) * 100", 4)} AS net_change_pct"""


@query(f"""{using("metrics_user")}
  SELECT id AS coin_id, {_SERIES_STATS}, {rounded("avg(volatility)", 6)} AS avg_volatility
  FROM metrics_user WHERE "timestamp" >= {_ALL} GROUP BY id""")
def coin_summary(spark, sf_dir):
    wide = inspect.unwrap(served.coin_summary)
    return wide(v.metrics_user(spark, sf_dir), AS_OF, ALL_MINUTES, order=USER_ORDER)


@query(f"""{using("metrics_type")}
  SELECT {_METRICS_OUT} FROM metrics_type WHERE id IN {v.TYPES}
  QUALIFY row_number() OVER (PARTITION BY id ORDER BY "timestamp" DESC, seq DESC) = 1""")
def compare_latest(spark, sf_dir):
    rows = served.compare_latest(v.metrics_type(spark, sf_dir), v.TYPES, USER_ORDER)
    return _shown(rows, *schemas.METRIC_COLUMNS)


@query(f"""{using("metrics_user")}
  SELECT id, min(symbol) AS symbol, {_SERIES_STATS}
  FROM metrics_user WHERE id IN (SELECT CAST(c_custkey AS VARCHAR) FROM customer)
    AND "timestamp" >= {_ALL} GROUP BY id""")
def compare_stats(spark, sf_dir):
    """The keys to compare come from a table, so the restriction is a semi join."""
    wide = inspect.unwrap(served.compare_stats)
    listed = v.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("id")
    )
    return wide(v.metrics_user(spark, sf_dir), listed, AS_OF, ALL_MINUTES, USER_ORDER)


_PAIRS = f"""{using("aligned")}
  SELECT a.id AS id_a, b.id AS id_b, {rounded("corr(a.price, b.price)", 4)} AS corr,
         count(*) AS overlap_points
  FROM aligned a JOIN aligned b ON a."timestamp" = b."timestamp" AND a.id < b.id
  WHERE a."timestamp" >= {_ALL} AND b."timestamp" >= {_ALL}
  GROUP BY a.id, b.id"""


@query(f"{_PAIRS} ORDER BY overlap_points DESC, id_a, id_b LIMIT 1")
def pair_corr(spark, sf_dir):
    wide = inspect.unwrap(served.pair_corr)
    return wide(v.aligned(spark, sf_dir), v.TYPES, AS_OF, ALL_MINUTES)


@query(_PAIRS)
def pair_corr_all(spark, sf_dir):
    return compare_ops.pair_correlations(v.aligned(spark, sf_dir), v.TYPES)


@query(f"""{using("metrics_type")}
  SELECT id, count(*) AS points, {rounded("avg(price)", 6)} AS avg_price
  FROM metrics_type WHERE "timestamp" >= {_WEEK} AND change_5min > -50 GROUP BY id""")
def table_query(spark, sf_dir):
    """A parameterised statement over registered frames."""
    lake.register({"metrics": v.metrics_type(spark, sf_dir)})
    return lake.query(
        spark,
        """SELECT id, count(*) AS points,
                  CAST(round(CAST(avg(price) AS DECIMAL(38,12)), 6) AS DOUBLE) AS avg_price
           FROM metrics WHERE timestamp >= :since AND change_5min > :least GROUP BY id""",
        {"since": AS_OF - timedelta(minutes=WEEK_MINUTES), "least": -50.0},
    )


@query("""
  SELECT c_custkey, len(ids) AS n_keys, array_to_string(ids, '|') AS keys, len(ids) >= 2 AS comparable
  FROM (SELECT c_custkey, list_filter(list_transform(string_split(
          ' ' || c_name || ' , ,' || c_mktsegment || ',' || c_name || '  ', ','),
          lambda x: lower(trim(x))), lambda x: x <> '') AS ids FROM customer)""")
def key_list_parse(spark, sf_dir):
    listed = F.concat(
        F.lit(" "), "c_name", F.lit(" , ,"), "c_mktsegment", F.lit(","), "c_name", F.lit("  ")
    )
    parsed = v.table(spark, sf_dir, "customer").select("c_custkey", key_list(listed).alias("ids"))
    return parsed.select(
        "c_custkey",
        F.size("ids").alias("n_keys"),
        F.array_join("ids", "|").alias("keys"),
        (F.size("ids") >= 2).alias("comparable"),
    )


# --- anomalies, risk ------------------------------------------------------------

_Z = """scored AS (
  SELECT *, (change_5min - avg(change_5min) OVER (PARTITION BY id))
            / nullif(stddev_pop(change_5min) OVER (PARTITION BY id), 0) AS z
  FROM {} WHERE change_5min IS NOT NULL AND "timestamp" >= {})"""
_ANOMALIES_OUT = f'id, symbol, "timestamp", price, change_5min, {rounded("z", 4)} AS z_score'


@query(f"""{using("metrics_user")}, {_Z.format("metrics_user", _ALL)}
  SELECT {_ANOMALIES_OUT} FROM scored WHERE abs(z) >= 2.0
  ORDER BY abs(z) DESC, "timestamp" DESC, id LIMIT 100""")
def anomalies(spark, sf_dir):
    wide = inspect.unwrap(served.anomalies)
    return wide(v.metrics_user(spark, sf_dir), AS_OF, ALL_MINUTES, 2.0)


@query(f"""{using("metrics_type")}, {_Z.format("metrics_type", _ALL)}
  SELECT {_ANOMALIES_OUT} FROM scored WHERE abs(z) >= 2.0""")
def anomalies_hot_keys(spark, sf_dir):
    """All anomalous rows, with every key spread over several join partitions."""
    metrics = v.metrics_type(spark, sf_dir)
    rows = anomaly_ops.anomalous(metrics, 2.0, _FINE)
    return rows.select(
        "id", "symbol", "timestamp", "price", "change_5min",
        round_half_up(F.col("z"), 4).alias("z_score"),
    )


@query(f"""{using("metrics_user")}, {_Z.format("metrics_user", _ALL)}
  SELECT id, count(*) AS anomaly_count FROM scored WHERE abs(z) >= 2.5 GROUP BY id""")
def anomaly_count(spark, sf_dir):
    return anomaly_ops.anomaly_count(v.metrics_user(spark, sf_dir))


def _drawdown_sql(source: str, since: str) -> str:
    return f"""drawdown AS (
  SELECT id, min(price / nullif(peak, 0) - 1) AS worst_drawdown FROM (
    SELECT id, price, max(price) OVER (PARTITION BY id ORDER BY "timestamp", seq
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS peak
    FROM {source} WHERE "timestamp" >= {since}) GROUP BY id)"""


_DRAWDOWN_OUT = f"SELECT id, {rounded('worst_drawdown', 9)} AS worst_drawdown FROM drawdown"


def _drawdown_out(rows):
    return rows.select("id", round_half_up(F.col("worst_drawdown"), 9).alias("worst_drawdown"))


@query(f'{using("ticks_user")}, {_drawdown_sql("ticks_user", _ALL)} {_DRAWDOWN_OUT}')
def drawdown(spark, sf_dir):
    return _drawdown_out(risk_ops.drawdown(v.ticks_user(spark, sf_dir), USER_ORDER))


@query(f'{using("ticks_type")}, {_drawdown_sql("ticks_type", _ALL)} {_DRAWDOWN_OUT}')
def drawdown_hot_keys(spark, sf_dir):
    return _drawdown_out(risk_ops.drawdown(v.ticks_type(spark, sf_dir), USER_ORDER, _FINE))


@query(f"""{using("metrics_user", "alerts")},
  scoped AS (SELECT * FROM metrics_user WHERE "timestamp" >= {_WEEK}),
  {_Z.format("scoped", _WEEK)}, {_drawdown_sql("scoped", _WEEK)},
  spread AS (SELECT id, count(*) AS points, coalesce(avg(volatility), 0) AS vol,
             coalesce(stddev_pop(change_5min), 0) AS dev FROM scoped GROUP BY id),
  odd AS (SELECT id, count(*) AS n FROM scored WHERE abs(z) >= 2.5 GROUP BY id),
  alerted AS (SELECT coin_id AS id, count(*) AS n FROM alerts WHERE alerted_at >= {_WEEK} GROUP BY coin_id),
  parts AS (
    SELECT coalesce(s.id, a.id) AS id, coalesce(s.points, 0) AS points, coalesce(s.vol, 0) AS vol,
           coalesce(s.dev, 0) AS dev, coalesce(d.worst_drawdown, 0) AS fall,
           coalesce(a.n, 0) AS alerts_count, coalesce(o.n, 0) AS anomaly_count
    FROM spread s LEFT JOIN drawdown d ON d.id = s.id LEFT JOIN odd o ON o.id = s.id
    FULL OUTER JOIN alerted a ON a.id = s.id),
  raw AS (SELECT *, greatest(0, least(100, least(35, vol * 25) + least(25, dev * 8)
    + least(25, abs(fall) * 100 * 0.8)
    + least(15, alerts_count * 0.7 + anomaly_count * 1.2))) AS score FROM parts)
  SELECT id AS coin_id, points, {rounded("score", 2)} AS risk_score,
         CASE WHEN score >= 70 THEN 'HIGH' WHEN score >= 40 THEN 'MEDIUM' ELSE 'LOW' END AS risk_band,
         {rounded("vol", 6)} AS avg_volatility, {rounded("dev", 6)} AS std_change_5min,
         {rounded("fall * 100", 4)} AS worst_drawdown_pct, alerts_count, anomaly_count,
         CAST({WEEK_MINUTES} AS INTEGER) AS window_minutes
  FROM raw""")
def risk_score(spark, sf_dir):
    metrics = written(v.metrics_user(spark, sf_dir), "metrics")
    return served.risk_score(
        metrics,
        alert_ops.price_alerts(metrics, F.col("timestamp"), 2.0),
        AS_OF,
        WEEK_MINUTES,
        order=USER_ORDER,
    )


# --- cross signals --------------------------------------------------------------


def _cross_sql(source: str) -> str:
    return f"""
  priced AS (SELECT * FROM {source} WHERE price IS NOT NULL AND "timestamp" >= {_ALL}),
  series AS (SELECT id, count(*) AS points, arg_min(price, {_MOMENT}) AS first_price,
             arg_max(price, {_MOMENT}) AS last_price, max({_MOMENT}) AS last_moment
             FROM priced GROUP BY id),
  sided AS (SELECT id, "timestamp", seq, price, CAST(sign(ema - sma) AS INTEGER) AS side FROM priced
            WHERE price <> 0 AND abs(ema - sma) > abs(sma) * 1e-12),
  turned AS (SELECT * FROM (SELECT *, lag(side) OVER (PARTITION BY id ORDER BY "timestamp", seq) AS before
             FROM sided) WHERE (side = 1 AND coalesce(before, -1) = -1) OR (side = -1 AND before = 1)),
  numbered AS (SELECT *, sum(CASE WHEN side = 1 THEN 1 ELSE 0 END)
               OVER (PARTITION BY id ORDER BY "timestamp", seq) AS trade_no FROM turned),
  held AS (SELECT id, trade_no, min("timestamp") FILTER (WHERE side = 1) AS entry_time,
           min(seq) FILTER (WHERE side = 1) AS entry_seq,
           min(price) FILTER (WHERE side = 1) AS entry_price,
           min("timestamp") FILTER (WHERE side = -1) AS sold_time,
           min(seq) FILTER (WHERE side = -1) AS sold_seq,
           min(price) FILTER (WHERE side = -1) AS sold_price FROM numbered GROUP BY id, trade_no),
  trades AS (SELECT h.id, h.entry_time, h.entry_price, h.entry_seq,
               coalesce(h.sold_time, s.last_moment.a) AS exit_time,
               coalesce(h.sold_seq, s.last_moment.b) AS exit_seq,
               coalesce(h.sold_price, nullif(s.last_price, 0)) AS exit_price,
               CASE WHEN h.sold_time IS NULL THEN 'SELL_EOD' ELSE 'SELL' END AS exit_action
             FROM held h JOIN series s ON s.id = h.id WHERE s.points >= 20),
  closed AS (SELECT *, {rounded("(exit_price - entry_price) / entry_price * 100", 4)} AS pnl_pct,
               ln(exit_price / entry_price * (0.999 * 0.999)) AS growth
             FROM trades WHERE exit_price IS NOT NULL)"""


_CROSS_USER = f'{using("metrics_user")}, {_cross_sql("metrics_user")}'
_CROSS_TYPE = f'{using("metrics_type")}, {_cross_sql("metrics_type")}'
_TRADES_OUT = """SELECT id, entry_time, entry_price, exit_time, exit_price, pnl_pct, exit_action
  FROM closed"""


def _cross(spark, sf_dir, part):
    wide = inspect.unwrap(served.backtest)
    metrics = written(v.metrics_user(spark, sf_dir), "metrics")
    return wide(metrics, AS_OF, ALL_MINUTES, order=USER_ORDER)[part]


@query(f"{_CROSS_USER} {_TRADES_OUT}")
def cross_trades(spark, sf_dir):
    return _cross(spark, sf_dir, "trades")


@query(f"{_CROSS_TYPE} {_TRADES_OUT}")
def cross_trades_hot_keys(spark, sf_dir):
    metrics = feature_ops.features(v.ticks_type(spark, sf_dir), USER_ORDER, _FINE)
    run = signals.cross_run(written(metrics, "metrics"), USER_ORDER, _FINE)
    return signals.cross_trades(run)


@query(f"""{_CROSS_USER},
  sums AS (SELECT id, count(*) AS n, count(*) FILTER (WHERE pnl_pct > 0) AS wins, sum(growth) AS growth
           FROM closed GROUP BY id),
  results AS (
    SELECT s.id, s.points, s.points >= 20 AS ok, coalesce(t.n, 0) AS n, coalesce(t.wins, 0) AS wins,
           CASE WHEN s.last_price = 0 AND EXISTS (SELECT 1 FROM trades o WHERE o.id = s.id AND o.exit_price IS NULL)
                THEN 1000.0 ELSE 1000.0 * exp(coalesce(t.growth, 0)) END AS equity,
           CASE WHEN s.last_price <> 0 THEN (s.last_price - s.first_price) / nullif(s.first_price, 0) * 100 END AS hold
    FROM series s LEFT JOIN sums t ON t.id = s.id)
  SELECT id AS coin_id, 'ema_cross' AS strategy, CAST({ALL_MINUTES} AS INTEGER) AS window_minutes, points,
         CASE WHEN ok THEN 1000.0::DOUBLE END AS initial_capital,
         CASE WHEN ok THEN {rounded("equity", 2)} END AS final_equity,
         CASE WHEN ok THEN {rounded("(equity - 1000.0) / 1000.0 * 100", 4)} END AS strategy_return_pct,
         CASE WHEN ok THEN {rounded("hold", 4)} END AS buy_hold_return_pct,
         CASE WHEN ok THEN {rounded("(equity - 1000.0) / 1000.0 * 100 - hold", 4)} END AS excess_return_pct,
         CASE WHEN ok THEN n END AS trades,
         CASE WHEN ok THEN {rounded("CAST(wins AS DOUBLE) / nullif(n, 0) * 100", 2)} END AS win_rate_pct,
         CASE WHEN NOT ok THEN 'Not enough points for backtest (need at least 20).' END AS error
  FROM results""")
def cross_backtest(spark, sf_dir):
    return _cross(spark, sf_dir, "result")


@query(f"""{_CROSS_USER},
  acted AS (
    SELECT id, entry_time AS time, entry_seq AS seq, 0 AS closing, 'BUY' AS action, entry_price AS price,
           1000.0 * exp(coalesce(sum(growth) OVER (PARTITION BY id ORDER BY entry_time, entry_seq
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) / entry_price * 0.999 AS qty
    FROM (SELECT t.*, c.growth FROM trades t LEFT JOIN closed c
          ON c.id = t.id AND c.entry_time = t.entry_time AND c.entry_seq = t.entry_seq)
    UNION ALL
    SELECT id, exit_time, exit_seq, CASE WHEN exit_action = 'SELL_EOD' THEN 1 ELSE 0 END,
           exit_action, exit_price, NULL FROM closed)
  SELECT id, time, action, price, {rounded("qty", 6)} AS qty FROM acted
  QUALIFY row_number() OVER (PARTITION BY id ORDER BY time DESC, seq DESC, closing DESC) <= 10""")
def cross_actions(spark, sf_dir):
    return _cross(spark, sf_dir, "recent_actions").withColumn(
        "qty", round_half_up(F.col("qty"), 6)
    )


# --- run metrics ----------------------------------------------------------------

_RUN_ORDER = ("created_at", "id")


@query(f"""{using("run_metrics")}
  SELECT run_id, CAST(coalesce(sum(records_pushed), 0) AS BIGINT) AS total_pushed
  FROM run_metrics GROUP BY run_id""")
def run_totals(spark, sf_dir):
    return runs.run_totals(v.run_metrics(spark, sf_dir))


_RUN_LATEST = """SELECT task, status, records_pushed, latency_ms, created_at FROM run_metrics
  QUALIFY row_number() OVER (PARTITION BY task ORDER BY created_at DESC, id DESC) = 1"""


@query(f'{using("run_metrics")} {_RUN_LATEST}')
def run_latest(spark, sf_dir):
    return served.run_latest(v.run_metrics(spark, sf_dir), _RUN_ORDER)


@query(f"""{using("run_metrics")}
  SELECT run_id, task, status, latency_ms, error_message, created_at FROM run_metrics
  WHERE status <> 'success' ORDER BY created_at DESC, id DESC LIMIT 20""")
def run_failures(spark, sf_dir):
    return served.run_failures(v.run_metrics(spark, sf_dir), 20, _RUN_ORDER)


@query(f"""{using("run_metrics")}, newest AS ({_RUN_LATEST})
  SELECT count(*) AS events, count(*) FILTER (WHERE status = 'success') AS success_count,
         count(*) FILTER (WHERE status <> 'success') AS failure_count,
         {rounded("count(*) FILTER (WHERE status = 'success')::DOUBLE / count(*) * 100", 2)} AS success_rate_pct,
         (SELECT bool_and(status = 'success') FROM newest) AS all_latest_ok
  FROM run_metrics""")
def run_health(spark, sf_dir):
    return runs.run_health(v.run_metrics(spark, sf_dir), _RUN_ORDER)


# --- freshness, quality, totals, snapshot ---------------------------------------

_LAG = f"epoch_us({_NOW}) - epoch_us(max(\"timestamp\"))"


@query(f"""{using("metrics_user")}
  SELECT max("timestamp") AS last_data_at, ({_LAG}) / 1e6 AS data_lag_seconds FROM metrics_user""")
def freshness(spark, sf_dir):
    return served.freshness(v.metrics_user(spark, sf_dir), AS_OF)


_DUPLICATES = """(SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) FROM (
    SELECT count(*) AS n FROM doubled GROUP BY id, "timestamp" HAVING count(*) > 1))"""


@query(f'{using("doubled")} SELECT {_DUPLICATES} AS duplicate_rows')
def duplicates(spark, sf_dir):
    return quality_ops.duplicates(v.doubled(spark, sf_dir))


@query(f"""{using("doubled", "run_metrics")},
  scoped AS (SELECT * FROM doubled WHERE "timestamp" >= {_WEEK}),
  base AS (
    SELECT (SELECT count(*) FROM scoped) AS rows_window,
           (SELECT count(DISTINCT id) FROM scoped) AS coins_window,
           count(*) AS rows_total, count(DISTINCT id) AS coins_total,
           max("timestamp") AS last_data_at,
           (SELECT coalesce({rounded("count(*) FILTER (WHERE price IS NULL) * 100.0::DOUBLE / nullif(count(*), 0)", 4)}, 0) FROM scoped) AS null_price_pct,
           (SELECT coalesce({rounded("count(*) FILTER (WHERE sma IS NULL OR ema IS NULL) * 100.0::DOUBLE / nullif(count(*), 0)", 4)}, 0) FROM scoped) AS null_ma_pct,
           {_DUPLICATES} AS duplicate_rows_total, ({_LAG}) / 1e6 AS lag_seconds
    FROM doubled),
  outcomes AS (
    SELECT count(*) FILTER (WHERE status = 'success') AS success_count,
           count(*) FILTER (WHERE status <> 'success') AS failure_count
    FROM run_metrics WHERE created_at >= {_WEEK}),
  judged AS (
    SELECT base.*, outcomes.*, greatest(0, {rounded('''100.0::DOUBLE - coalesce(least(35, lag_seconds / 60), 0)
      - least(20, null_price_pct * 1.2) - least(15, null_ma_pct * 0.6)
      - least(20, duplicate_rows_total * 0.05::DOUBLE) - least(10, failure_count * 2.0::DOUBLE)''', 2)}) AS quality_score
    FROM base, outcomes)
  SELECT *, CASE WHEN quality_score < 45 THEN 'CRITICAL' WHEN quality_score < 70 THEN 'WARN' ELSE 'GOOD' END AS status,
         CAST({WEEK_MINUTES} AS INTEGER) AS window_minutes
  FROM judged""")
def data_quality(spark, sf_dir):
    return served.data_quality(
        v.doubled(spark, sf_dir), v.run_metrics(spark, sf_dir), AS_OF, WEEK_MINUTES
    )


@query(f"""{using("metrics_user", "ticks_type", "alerts", "run_metrics")}, {_HOURLY}
  SELECT (SELECT count(DISTINCT id) FROM metrics_user) AS coins_tracked,
         (SELECT max("timestamp") FROM metrics_user) AS last_updated,
         (SELECT count(*) FROM candles) AS ohlcv_candles, (SELECT count(*) FROM alerts) AS total_alerts,
         count(*) AS pipeline_events, count(*) FILTER (WHERE status = 'success') AS pipeline_successes,
         {rounded("count(*) FILTER (WHERE status = 'success')::DOUBLE / count(*) * 100", 2)} AS pipeline_success_rate
  FROM run_metrics""")
def stats(spark, sf_dir):
    return served.stats(
        v.metrics_user(spark, sf_dir),
        _hourly(spark, sf_dir),
        _alert_history(spark, sf_dir),
        v.run_metrics(spark, sf_dir),
    )


def _market(spark, sf_dir, part):
    return served.market_snapshot(
        v.metrics_user(spark, sf_dir),
        v.run_metrics(spark, sf_dir),
        AS_OF,
        USER_ORDER,
        _RUN_ORDER,
        minutes=ALL_MINUTES,
    )[part]


@query(f"""{using("metrics_user")}
  SELECT count(DISTINCT id) AS coins_tracked, max("timestamp") AS last_updated FROM metrics_user""")
def market_snapshot_stats(spark, sf_dir):
    return _market(spark, sf_dir, "stats")


@query(f"""{using("metrics_user")}, {_LATEST}
  SELECT id, symbol, "timestamp", price, change_1min, change_5min FROM latest ORDER BY id LIMIT 30""")
def market_snapshot(spark, sf_dir):
    return _market(spark, sf_dir, "latest")


@query(f"""{using("metrics_user")}, {_Z.format("metrics_user", _ALL)}
  SELECT id, symbol, "timestamp", price, change_5min FROM scored WHERE abs(z) >= 2.5
  ORDER BY "timestamp" DESC, id DESC LIMIT 10""")
def market_snapshot_anomalies(spark, sf_dir):
    return _market(spark, sf_dir, "anomalies")


@query(f'{using("run_metrics")} {_RUN_LATEST}')
def market_snapshot_runs(spark, sf_dir):
    return _market(spark, sf_dir, "runs")


# --- validation -----------------------------------------------------------------


def _judged_letters(spark, sf_dir):
    quotes = v.quotes(spark, sf_dir)
    run = F.concat(F.lit("run_"), F.date_format("timestamp", "yyyyMMdd"))
    return validation.dead_letters(quotes, run, F.col("timestamp"))


_LETTERS = """letters AS (
  SELECT event_id, 'run_' || strftime("timestamp", '%Y%m%d') AS run_id, reason AS error_message,
         "timestamp" AS created_at FROM judged WHERE reason IS NOT NULL)"""


@query(f'{using("judged")}, {_LETTERS} SELECT * FROM letters')
def dead_letter_split(spark, sf_dir):
    """Rejected quotes; the number of each comes back out of its JSON payload."""
    return _judged_letters(spark, sf_dir).select(
        F.get_json_object("payload", "$.event_id").cast("long").alias("event_id"),
        "run_id",
        "error_message",
        "created_at",
    )


@query(f"""{using("judged")}, {_LETTERS}
  SELECT run_id, error_message, created_at FROM letters
  ORDER BY created_at DESC, run_id DESC, error_message DESC LIMIT 20""")
def recent_dead_letters(spark, sf_dir):
    return served.recent_dead_letters(
        _judged_letters(spark, sf_dir), 20, ("created_at", "run_id", "error_message")
    )


@query(f"""{using("judged")}
  SELECT event_id, id, symbol, current_price, market_cap, CAST(NULL AS DOUBLE) AS total_volume,
         CAST(NULL AS DOUBLE) AS high_24h, CAST(NULL AS DOUBLE) AS low_24h,
         CAST(NULL AS VARCHAR) AS last_updated
  FROM judged WHERE reason IS NULL""")
def quote_project(spark, sf_dir):
    valid = validation.valid_quotes(v.quotes(spark, sf_dir))
    return validation.project_quote(valid, "event_id")


@query(f"""{using("judged")}
  SELECT CAST("timestamp" AS DATE) AS day, count(*) AS records,
         count(*) FILTER (WHERE reason IS NULL) AS valid_records, count(*) < 20 AS below_expected,
         CASE WHEN count(*) FILTER (WHERE reason IS NULL) = 0
              THEN 'No valid coins after quality checks' END AS failure
  FROM judged GROUP BY CAST("timestamp" AS DATE)""")
def batch_guard(spark, sf_dir):
    dated = v.quotes(spark, sf_dir).withColumn("day", F.to_date("timestamp"))
    return validation.batch_guard(dated, ["day"])


# --- messages and streams -------------------------------------------------------

_HOUR = "date_trunc('hour', \"timestamp\")"
_HOUR_TEXT = f"strftime({_HOUR}, '%Y-%m-%d %H:%M:%S')"


def _hourly_quotes(quotes: DataFrame) -> DataFrame:
    """Quotes in hourly batches."""
    return quotes.withColumn("timestamp", bucket(F.col("timestamp"), "1 hour"))


def _type_quotes(spark, sf_dir):
    ticks = v.ticks_type(spark, sf_dir)
    return ticks.select(
        "id",
        "symbol",
        F.col("price").alias("current_price"),
        F.col("seq").alias("market_cap"),
        "timestamp",
    )


def _messages(spark, sf_dir):
    return messages.envelopes(_hourly_quotes(_type_quotes(spark, sf_dir)))


@query(f"""{using("ticks_type")}
  SELECT {_HOUR_TEXT} AS message_timestamp, count(*) AS records,
         {rounded("sum(price)", 2)} AS total_price
  FROM ticks_type GROUP BY {_HOUR_TEXT}""")
def envelope_build(spark, sf_dir):
    parsed = messages.parsed_messages(_messages(spark, sf_dir))
    total = F.aggregate(
        "message.data", F.lit(0.0), lambda total, record: total + record["current_price"]
    )
    return parsed.select(
        F.col("message.timestamp").alias("message_timestamp"),
        F.size("message.data").cast("long").alias("records"),
        round_half_up(total, 2).alias("total_price"),
    )


@query(f"""{using("ticks_type")}
  SELECT {_HOUR_TEXT} AS "timestamp", id, symbol, price, seq AS market_cap,
         CAST(NULL AS DOUBLE) AS total_volume, CAST(NULL AS DOUBLE) AS high_24h,
         CAST(NULL AS DOUBLE) AS low_24h, CAST(NULL AS VARCHAR) AS last_updated
  FROM ticks_type""")
def json_flatten(spark, sf_dir):
    return messages.flatten(_messages(spark, sf_dir))


_LANDED = f"""{using("ticks_type")}
  SELECT {_HOUR} AS "timestamp", id, symbol, price, seq AS market_cap, CAST({_HOUR} AS DATE) AS dt
  FROM ticks_type WHERE price > 0"""


@query(_LANDED)
def stream_ingest(spark, sf_dir):
    """Messages written as lines of text, then streamed into a dated lake until none is left."""
    inbox, path, checkpoint = (scratch(spark, n) for n in ("inbox", "lake", "checkpoint"))
    _messages(spark, sf_dir).select("value").write.text(inbox)
    feed = messages.read_messages(spark, "text", {}, inbox)
    ingest.start_ticks(feed, path, checkpoint, backfill=True).awaitTermination()
    return spark.read.parquet(path).select("timestamp", "id", "symbol", "price", "market_cap", "dt")


@query(f"""{using("aligned")}
  SELECT "timestamp", id, upper(id) AS symbol, price, CAST(NULL AS BIGINT) AS market_cap,
         CAST("timestamp" AS DATE) AS dt
  FROM aligned WHERE price > 0""")
def stream_ingest_once(spark, sf_dir):
    """Every message sent twice at once, and again to the stream when it is started anew."""
    inbox, path, checkpoint = (scratch(spark, n) for n in ("inbox", "lake", "checkpoint"))
    quotes = v.aligned(spark, sf_dir).select(
        "id",
        F.upper("id").alias("symbol"),
        F.col("price").alias("current_price"),
        F.lit(None).cast("long").alias("market_cap"),
        "timestamp",
    )
    sent = messages.envelopes(quotes).select("value")
    for _ in range(2):
        sent.unionAll(sent).write.mode("append").text(inbox)
        feed = messages.read_messages(spark, "text", {}, inbox)
        ingest.start_ticks(
            feed, path, checkpoint, backfill=True, repeats_within="1 hour"
        ).awaitTermination()
    return spark.read.parquet(path).select("timestamp", "id", "symbol", "price", "market_cap", "dt")


# The newest bucket that the stream closes ends ten minutes before the newest tick.
_STREAM_HOURLY = _HOURLY.split("HAVING")[0] + f"""
  HAVING date_trunc('HOUR', "timestamp") + INTERVAL 70 MINUTE <= (SELECT max("timestamp") FROM ticks_type))"""


@query(f'{using("ticks_type")}, {_STREAM_HOURLY} SELECT * FROM candles')
def stream_candles(spark, sf_dir):
    """Streamed candles; every tenth tick comes after its bucket has closed, and amends it."""
    inbox, path, checkpoint = (scratch(spark, n) for n in ("inbox", "candles", "checkpoint"))
    rows = v.ticks_type(spark, sf_dir)
    late = F.pmod(F.col("seq"), F.lit(10)) == 0
    hour = timedelta(hours=1)
    for part in (rows.filter(~late), rows.filter(late)):
        part.write.mode("append").parquet(inbox)
        feed = spark.readStream.schema(rows.schema).parquet(inbox)
        stream_candle_ops.start_candles(
            feed, path, checkpoint, hour, USER_ORDER, backfill=True
        ).awaitTermination()
    streamed = spark.read.parquet(path)
    amendments = stream_candle_ops.amendments(rows, streamed, hour, USER_ORDER)
    return stream_candle_ops.amended(streamed, amendments)


@query(f"""{using("ticks_type")}
  SELECT "timestamp", id, symbol, price, seq, CAST("timestamp" AS DATE) AS dt FROM ticks_type
  WHERE "timestamp" >= {_WEEK}""")
def scan_ticks(spark, sf_dir):
    """A look-back on a dated lake, which reads only the dates it needs."""
    path = scratch(spark, "lake")
    tables.append(v.ticks_type(spark, sf_dir), path, "timestamp")
    return recent(lake.scan_ticks(spark, path, "seq"), AS_OF, WEEK_MINUTES)


@query(f"""{using("judged")}
  SELECT id, symbol, current_price, market_cap, reason FROM judged""")
def quote_landing(spark, sf_dir):
    """Upstream responses landed as JSON lists, read back and judged record by record."""
    inbox = scratch(spark, "responses")
    sent = messages.responses(_hourly_quotes(v.quotes(spark, sf_dir)), "timestamp")
    sent.select("value").write.text(inbox)
    landed = messages.landed_quotes(messages.read_messages(spark, "text", {}, inbox, streaming=False))
    return validation.with_reason(landed).select(
        "id", "symbol", "current_price", "market_cap", "reason"
    )


@query(f"""{using("judged")}
  SELECT count(*) AS records, true AS all_lists, count(DISTINCT {_HOUR}) AS batches FROM judged""")
def response_guard(spark, sf_dir):
    """Upstream responses that are lists, and the records in them."""
    batches = _hourly_quotes(v.quotes(spark, sf_dir))
    guarded = messages.response_guard(messages.responses(batches, "timestamp"), ["timestamp"])
    return guarded.agg(
        F.sum("records").alias("records"),
        F.bool_and("is_list").alias("all_lists"),
        F.count_distinct("timestamp").alias("batches"),
    )


@query(f"""{using("judged")}
  SELECT {_HOUR_TEXT} AS run_id, count(*) AS published, count(*) FILTER (WHERE reason IS NULL) AS landed,
         count(*) FILTER (WHERE reason IS NOT NULL) AS missing,
         count(*) FILTER (WHERE reason IS NOT NULL) = 0 AS complete
  FROM judged GROUP BY {_HOUR_TEXT}""")
def delivery_reconcile(spark, sf_dir):
    """Records in the published messages against those that a written lake holds."""
    sent = messages.envelopes(_hourly_quotes(v.quotes(spark, sf_dir)))
    published = messages.parsed_messages(sent).select(
        F.col("message.timestamp").alias("run_id"),
        F.size("message.data").alias("records_pushed"),
    )
    lake_path = scratch(spark, "lake")
    valid = validation.valid_quotes(ingest.quotes_of(sent))
    valid.withColumnRenamed("timestamp", "run_id").write.parquet(lake_path)
    return reconcile.reconcile(published, spark.read.parquet(lake_path))


_BUS = f"""bus AS (
  SELECT {_HOUR} AS hour, CAST(floor(epoch({_HOUR}) / 3600) AS BIGINT) AS "offset",
         CAST(floor(epoch({_HOUR}) / 3600) AS BIGINT) % 3 AS "partition", count(*) AS records
  FROM ticks_type GROUP BY {_HOUR})"""


@query(f"""{using("ticks_type")}, {_BUS}
  SELECT 'ticks' AS topic, "partition", max("offset") AS "offset",
         strftime(arg_max(hour, "offset"), '%Y-%m-%d %H:%M:%S') AS message_timestamp,
         true AS well_formed, arg_max(records, "offset") AS records
  FROM bus GROUP BY "partition" """)
def delivery_newest(spark, sf_dir):
    """The newest message of each partition of a topic."""
    hour = F.floor(F.unix_micros(F.col("timestamp").cast("timestamp")) / 3_600_000_000)
    sent = _messages(spark, sf_dir).select(
        F.lit("ticks").alias("topic"),
        (hour % 3).alias("partition"),
        hour.alias("offset"),
        F.col("value").cast("binary").alias("value"),
    )
    return reconcile.newest_messages(sent).withColumn("records", F.col("records").cast("long"))


# --- sinks ----------------------------------------------------------------------

# The stored half ends after the incoming half begins.
_STORED_UNTIL = datetime(2024, 1, 20)
_INCOMING_FROM = datetime(2024, 1, 12, 12)
_OLD = f"\"timestamp\" < TIMESTAMP '{_STORED_UNTIL}'"
_NEW = f"\"timestamp\" >= TIMESTAMP '{_INCOMING_FROM}'"


def _halves(rows: DataFrame):
    stored = rows.filter(F.col("timestamp") < F.lit(_STORED_UNTIL))
    incoming = rows.filter(F.col("timestamp") >= F.lit(_INCOMING_FROM))
    return stored, incoming


def _metrics_back(spark, path):
    rows = tables.read_table(spark, path, schemas.METRICS)
    return _shown(rows, *schemas.METRIC_COLUMNS)


@query(f"""{using("metrics_user")}, halves AS (
  SELECT "timestamp", id, CASE WHEN {_OLD} THEN symbol ELSE symbol || '*' END AS symbol,
         CASE WHEN {_NEW} THEN price + 1 ELSE price END AS price, change_1min,
         CASE WHEN {_NEW} THEN NULL ELSE change_5min END AS change_5min, sma, ema, volatility
  FROM metrics_user
  UNION ALL
  SELECT NULL, 'old ' || id, symbol, max(price), NULL, NULL, NULL, NULL, NULL
  FROM metrics_user GROUP BY id, symbol
  UNION ALL
  SELECT NULL, 'new ' || id, symbol || '*', max(price) + 1, NULL, NULL, NULL, NULL, NULL
  FROM metrics_user GROUP BY id, symbol)
  SELECT {_METRICS_OUT} FROM halves""")
def sink_upsert(spark, sf_dir):
    """Incoming values win, nulls too, but the stored symbol stays; rows without a time stay."""
    path = scratch(spark, "metrics")
    rows = v.metrics_user(spark, sf_dir).drop("seq")
    stored, incoming = _halves(rows)
    untimed = rows.groupBy("id", "symbol").agg(F.max("price").alias("price"))
    empty = {c: F.lit(None).cast(schemas.METRICS[c].dataType) for c in rows.columns}

    def planted(kind: str):
        named = {"id": F.concat(F.lit(kind), "id"), "symbol": F.col("symbol"), "price": F.col("price")}
        return untimed.select(*(named.get(c, empty[c]).alias(c) for c in rows.columns))

    stored = stored.unionByName(planted("old "))
    incoming = incoming.unionByName(planted("new "))
    changed = incoming.withColumns(
        {
            "symbol": F.concat("symbol", F.lit("*")),
            "price": F.col("price") + 1,
            "change_5min": F.lit(None).cast("double"),
        }
    )
    tables.upsert(stored, path, schemas.METRICS)
    tables.upsert(changed, path, schemas.METRICS)
    return _metrics_back(spark, path)


@query(f"""{using("metrics_user")}
  SELECT {_METRICS_OUT} FROM metrics_user""")
def sink_compact(spark, sf_dir):
    """Rows of a table that came in many small writes are all there after compaction."""
    path = scratch(spark, "metrics")
    rows = v.metrics_user(spark, sf_dir).drop("seq")
    for part in range(3):
        tables.append(rows.filter(F.pmod(F.xxhash64("id"), F.lit(3)) == part), path, "timestamp")
    for _ in range(2):
        tables.compact(spark, path, schemas.METRICS, _STORED_UNTIL.date())
    return _metrics_back(spark, path)


@query(f"""{using("ticks_type")}, {_HOURLY}
  SELECT id, symbol, "timestamp", CASE WHEN {_OLD} THEN open ELSE open + 1 END AS open,
         high, low, close FROM candles""")
def sink_insert_ignore(spark, sf_dir):
    """Stored candles stay as they are."""
    path = scratch(spark, "candles")
    stored, incoming = _halves(_hourly(spark, sf_dir))
    tables.insert_ignore(stored, path, schemas.CANDLES)
    tables.insert_ignore(incoming.withColumn("open", F.col("open") + 1), path, schemas.CANDLES)
    return tables.read_table(spark, path, schemas.CANDLES).select(*schemas.CANDLE_COLUMNS)


@query(_ranked("ASC"))
def sink_replace(spark, sf_dir):
    """A second snapshot takes the place of the first."""
    path = scratch(spark, "movers")
    latest = _latest(spark, sf_dir)
    tables.replace_snapshot(ranking.top_gainers(latest), path, "20240130T000000")
    tables.replace_snapshot(ranking.top_losers(latest), path, "20240131T000000")
    return served.snapshot_ranking(tables.current_snapshot(spark, path, schemas.MOVERS))


@query(f"""{using("alerts")}
  SELECT alerted_at, coin_id, symbol, price, change_5min, alert_type FROM alerts""")
def sink_append_alerts(spark, sf_dir):
    """Two runs append; the second runs twice and leaves its rows once."""
    path = scratch(spark, "alerts")
    history = _alert_history(spark, sf_dir)
    early = F.col("alerted_at") < F.lit(_STORED_UNTIL)
    tables.append_run(history.filter(early), path, "run-1", "alerted_at")
    for _ in range(2):
        tables.append_run(history.filter(~early), path, "run-2", "alerted_at")
    return tables.read_table(spark, path, schemas.ALERTS).select(*schemas.ALERTS.fieldNames())


@query(f"""{using("run_metrics")}
  SELECT run_id, task, status, records_pushed, latency_ms, error_message, created_at FROM run_metrics""")
def sink_run_metrics(spark, sf_dir):
    path = scratch(spark, "run-metrics")
    rows = v.run_metrics(spark, sf_dir).select(*schemas.RUN_METRICS.fieldNames())
    failed = F.col("status") != runs.OK
    tables.append(rows.filter(failed), path, "created_at")
    tables.append(rows.filter(~failed), path, "created_at")
    back = tables.read_table(spark, path, schemas.RUN_METRICS)
    return back.select(*schemas.RUN_METRICS.fieldNames())


# Retention runs at noon, so that its bound falls inside a date.
_RETAIN_AT = datetime(2024, 1, 30, 12)
_KEPT_FROM = f"TIMESTAMP '{_RETAIN_AT - timedelta(days=7)}'"


@query(f"""{using("metrics_user")}
  SELECT {_METRICS_OUT}, (SELECT count(*) FROM metrics_user WHERE "timestamp" < {_KEPT_FROM}) AS removed
  FROM metrics_user WHERE "timestamp" >= {_KEPT_FROM}""")
def retention(spark, sf_dir):
    """Rows left after seven days of retention, with the number removed."""
    path = scratch(spark, "metrics")
    tables.append(v.metrics_user(spark, sf_dir).drop("seq"), path, "timestamp")
    removed = tables.retain(spark, path, schemas.METRICS, "timestamp", _RETAIN_AT, 7)
    return _metrics_back(spark, path).withColumn("removed", F.lit(removed).cast("long"))


# --- the maintained table of latest rows ----------------------------------------

_LATEST_SCHEMA = T.StructType([*schemas.METRICS.fields, T.StructField("seq", T.LongType())])


def _latest_table(spark, sf_dir):
    """Merged from three runs, the newest first, so that two come late; one of them runs twice."""
    path = scratch(spark, "latest")
    rows = v.metrics_user(spark, sf_dir)
    third = F.pmod(F.xxhash64("id", "timestamp"), F.lit(3))
    parts = [rows.filter(F.col("timestamp") >= F.lit(_INCOMING_FROM))]
    parts += [rows.filter((F.col("timestamp") < F.lit(_STORED_UNTIL)) & part) for part in (third > 0, third == 0)]
    for part in [*parts, parts[1]]:
        merge_latest(part, path, _LATEST_SCHEMA, USER_ORDER)
    return path, read_latest(spark, path, _LATEST_SCHEMA)


@query(f'{using("metrics_user")}, {_LATEST} SELECT {_METRICS_OUT} FROM latest')
def latest_table_prices(spark, sf_dir):
    """The latest prices, from the maintained table and without a look at the history."""
    rows = served.latest_prices(_latest_table(spark, sf_dir)[1], USER_ORDER)
    return _shown(rows, *schemas.METRIC_COLUMNS)


@query(f'{using("metrics_user")} SELECT DISTINCT id, symbol FROM metrics_user')
def latest_table_coins(spark, sf_dir):
    return served.coin_list(_latest_table(spark, sf_dir)[1])


@query(ORACLES["stats"])
def latest_table_stats(spark, sf_dir):
    return served.stats(
        _latest_table(spark, sf_dir)[1],
        _hourly(spark, sf_dir),
        _alert_history(spark, sf_dir),
        v.run_metrics(spark, sf_dir),
    )


@query(ORACLES["market_snapshot"])
def latest_table_snapshot(spark, sf_dir):
    return served.market_snapshot(
        v.metrics_user(spark, sf_dir),
        v.run_metrics(spark, sf_dir),
        AS_OF,
        USER_ORDER,
        _RUN_ORDER,
        minutes=ALL_MINUTES,
        kept=_latest_table(spark, sf_dir)[1],
    )["latest"]


@query(f"""{using("metrics_user")}, {_LATEST}
  SELECT {_METRICS_OUT}, (SELECT count(*) FROM latest WHERE "timestamp" < {_KEPT_FROM}) AS removed
  FROM latest WHERE "timestamp" >= {_KEPT_FROM}""")
def latest_table_retention(spark, sf_dir):
    """Keys whose newest row is past retention leave the table."""
    path, _ = _latest_table(spark, sf_dir)
    removed = expire_latest(spark, path, _LATEST_SCHEMA, "timestamp", _RETAIN_AT, 7)
    rows = _shown(read_latest(spark, path, _LATEST_SCHEMA), *schemas.METRIC_COLUMNS)
    return rows.withColumn("removed", F.lit(removed).cast("long"))


# --- results published together --------------------------------------------------


def _published(spark, sf_dir, name, kept, change, folded=False):
    """Two runs, the second with changed rows and published twice; a third that dies before its manifest."""
    root = scratch(spark, "published")
    rows = v.metrics_user(spark, sf_dir).drop("seq") if kept.schema == schemas.METRICS else _hourly(spark, sf_dir)
    stored, incoming = _halves(rows)
    publish.publish(spark, root, "run-1", {name: (stored, kept)})
    for _ in range(2):
        publish.publish(spark, root, "run-2", {name: (incoming.withColumns(change), kept)})
    lost = F.raise_error(F.lit("lost")).cast("double")
    column = next(iter(change))
    try:
        broken = stored.withColumn(column, lost.cast(kept.schema[column].dataType))
        publish.publish(spark, root, "run-3", {name: (incoming, kept), f"{name}-2": (broken, kept)})
    except Exception as failure:
        if "lost" not in str(failure):
            raise
    if folded:
        publish.fold(spark, root, {name: kept}, most=1)
    return publish.read_published(spark, root, name, kept)


def _changed():
    return {
        "symbol": F.concat("symbol", F.lit("*")),
        "price": F.col("price") + 1,
        "change_5min": F.lit(None).cast("double"),
    }


@query(f"""{using("metrics_user")}, halves AS (
  SELECT "timestamp", id, CASE WHEN {_OLD} THEN symbol ELSE symbol || '*' END AS symbol,
         CASE WHEN {_NEW} THEN price + 1 ELSE price END AS price, change_1min,
         CASE WHEN {_NEW} THEN NULL ELSE change_5min END AS change_5min, sma, ema, volatility
  FROM metrics_user)
  SELECT {_METRICS_OUT} FROM halves""")
def publish_upsert(spark, sf_dir):
    """Read from deltas: the newest run's values, nulls too, and the first run's symbol."""
    kept = publish.Published(schemas.METRICS, publish.UPSERT, keep=("symbol",))
    return _shown(_published(spark, sf_dir, "metrics", kept, _changed()), *schemas.METRIC_COLUMNS)


@query(ORACLES["publish_upsert"])
def publish_folded(spark, sf_dir):
    """The same rows after the deltas were folded into one."""
    kept = publish.Published(schemas.METRICS, publish.UPSERT, keep=("symbol",))
    return _shown(_published(spark, sf_dir, "metrics", kept, _changed(), folded=True), *schemas.METRIC_COLUMNS)


@query(ORACLES["sink_insert_ignore"])
def publish_insert(spark, sf_dir):
    """Candles of the first run stay as they are."""
    kept = publish.Published(schemas.CANDLES, publish.INSERT)
    rows = _published(spark, sf_dir, "candles", kept, {"open": F.col("open") + 1})
    return rows.select(*schemas.CANDLE_COLUMNS)
