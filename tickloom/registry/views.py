"""The tick-shaped views over the given tables, as frames and as SQL of the same meaning."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.functions.clock import bucket
from tickloom.operators.features import features

# The clock of all registered queries, and a look-back that spans the whole tables.
AS_OF = datetime(2024, 1, 31)
ALL_MINUTES = 31 * 24 * 60
WEEK_MINUTES = 7 * 24 * 60

USER_ORDER = ("timestamp", "seq")
ITEM_ORDER = ("timestamp", "l_orderkey", "l_linenumber", "l_partkey", "price")
TYPES = ("click", "error", "purchase", "signup", "view")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ticks_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Many keys with few rows each."""
    user = F.col("user_id").cast("string")
    return table(spark, sf_dir, "events").select(
        user.alias("id"),
        F.concat(F.lit("u"), user).alias("symbol"),
        F.col("ts").alias("timestamp"),
        F.col("value").alias("price"),
        F.col("event_id").alias("seq"),
    )


def ticks_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five keys with many rows each."""
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("id"),
        F.upper("event_type").alias("symbol"),
        F.col("ts").alias("timestamp"),
        F.col("value").alias("price"),
        F.col("event_id").alias("seq"),
    )


def ticks_item(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The largest table, with many rows on the same key and time."""
    supplier = F.col("l_suppkey").cast("string")
    return table(spark, sf_dir, "lineitem").select(
        supplier.alias("id"),
        F.concat(F.lit("s"), supplier).alias("symbol"),
        F.col("l_shipdate").alias("timestamp"),
        F.col("l_extendedprice").alias("price"),
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
    )


def metrics_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features(ticks_user(spark, sf_dir), USER_ORDER)


def metrics_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features(ticks_type(spark, sf_dir), USER_ORDER)


def aligned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five keys on a common hourly grid."""
    ticks = ticks_type(spark, sf_dir).withColumn("hour", bucket(F.col("timestamp"), "1 hour"))
    last = F.max_by("price", F.struct("timestamp", "seq"))
    return ticks.groupBy("id", F.col("hour").alias("_hour")).agg(last.alias("price")).select(
        "id", F.col("_hour").alias("timestamp"), "price"
    )


def run_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    failed = F.col("event_type") == "error"
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("id"),
        F.concat(F.lit("run_"), F.col("user_id").cast("string")).alias("run_id"),
        F.concat(F.lit("task_"), (F.col("user_id") % 4).cast("string")).alias("task"),
        F.when(failed, "failure").otherwise("success").alias("status"),
        F.get_json_object("props", "$.k").try_cast("int").alias("records_pushed"),
        F.floor(F.col("value") * 10).cast("int").alias("latency_ms"),
        F.when(failed, F.concat(F.lit("err "), F.col("props"))).alias("error_message"),
        F.col("ts").alias("created_at"),
    )


def quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quotes with planted faults: no key, no price, a negative or a zero price."""
    n = F.col("event_id")
    price = (
        F.when(n % 17 == 0, None)
        .when(n % 19 == 0, -F.col("value"))
        .when(n % 23 == 0, 0.0)
        .otherwise(F.col("value"))
    )
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.when(n % 13 != 0, F.col("user_id").cast("string")).alias("id"),
        F.col("event_type").alias("symbol"),
        price.alias("current_price"),
        n.alias("market_cap"),
        F.col("ts").alias("timestamp"),
    )


def doubled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics of which the rows of one kind are stored twice."""
    metrics = metrics_user(spark, sf_dir)
    again = table(spark, sf_dir, "events").filter(F.col("event_type") == "error")
    return metrics.unionByName(
        metrics.join(again.select(F.col("event_id").alias("seq")), "seq", "left_semi")
    )


_USER = """
  SELECT CAST(user_id AS VARCHAR) AS id, 'u' || CAST(user_id AS VARCHAR) AS symbol,
         ts AS "timestamp", value AS price, event_id AS seq
  FROM events"""
_TYPE = """
  SELECT event_type AS id, upper(event_type) AS symbol,
         ts AS "timestamp", value AS price, event_id AS seq
  FROM events"""
_ITEM = """
  SELECT CAST(l_suppkey AS VARCHAR) AS id, 's' || CAST(l_suppkey AS VARCHAR) AS symbol,
         l_shipdate AS "timestamp", l_extendedprice AS price, l_orderkey, l_linenumber, l_partkey
  FROM lineitem"""


def rounded(expression: str, places: int) -> str:
    """Half-up rounding on decimals, as a double."""
    return f"CAST(round(CAST({expression} AS DECIMAL(38,12)), {places}) AS DOUBLE)"


def rounded_digits(expression: str, places: int) -> str:
    """Half-up rounding of the printed digits of a double, which is what ``round`` does."""
    digits = f"CAST(CAST({expression} AS VARCHAR) AS DECIMAL(38,18))"
    return f"CAST(round({digits}, {places}) AS DOUBLE)"


def features_sql(source: str, order: str, extra: str = "") -> str:
    one, five = "lag(price, 1) OVER w", "lag(price, 5) OVER w"
    frame = f'OVER (PARTITION BY id ORDER BY {order} ROWS BETWEEN {{}} PRECEDING AND CURRENT ROW)'
    return f"""
  SELECT "timestamp", id, symbol, price,
         {rounded_digits(f"(price - {one}) / nullif({one}, 0) * 100", 2)} AS change_1min,
         {rounded_digits(f"(price - {five}) / nullif({five}, 0) * 100", 2)} AS change_5min,
         avg(price) {frame.format(4)} AS sma,
         avg(price) {frame.format(2)} AS ema,
         stddev_samp(price) {frame.format(4)} AS volatility{extra}
  FROM {source}
  WINDOW w AS (PARTITION BY id ORDER BY {order})"""


_ITEM_ORDER = '"timestamp", l_orderkey, l_linenumber, l_partkey, price'

VIEWS = {
    "ticks_user": _USER,
    "ticks_type": _TYPE,
    "ticks_item": _ITEM,
    "metrics_user": features_sql(f"({_USER})", '"timestamp", seq', ", seq"),
    "metrics_type": features_sql(f"({_TYPE})", '"timestamp", seq', ", seq"),
    "metrics_item": features_sql(f"({_ITEM})", _ITEM_ORDER),
    "aligned": f"""
  SELECT id, date_trunc('hour', "timestamp") AS "timestamp",
         arg_max(price, struct_pack(t := "timestamp", s := seq)) AS price
  FROM ({_TYPE}) GROUP BY id, date_trunc('hour', "timestamp")""",
    "run_metrics": """
  SELECT event_id AS id, 'run_' || CAST(user_id AS VARCHAR) AS run_id,
         'task_' || CAST(user_id % 4 AS VARCHAR) AS task,
         CASE WHEN event_type = 'error' THEN 'failure' ELSE 'success' END AS status,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS records_pushed,
         CAST(floor(value * 10) AS INTEGER) AS latency_ms,
         CASE WHEN event_type = 'error' THEN 'err ' || props END AS error_message,
         ts AS created_at
  FROM events""",
    "quotes": """
  SELECT event_id, CASE WHEN event_id % 13 <> 0 THEN CAST(user_id AS VARCHAR) END AS id,
         event_type AS symbol,
         CASE WHEN event_id % 17 = 0 THEN NULL WHEN event_id % 19 = 0 THEN -value
              WHEN event_id % 23 = 0 THEN 0.0 ELSE value END AS current_price,
         event_id AS market_cap, ts AS "timestamp"
  FROM events""",
}
VIEWS["doubled"] = f"""
  SELECT * FROM ({VIEWS["metrics_user"]})
  UNION ALL
  SELECT m.* FROM ({VIEWS["metrics_user"]}) m
  WHERE m.seq IN (SELECT event_id FROM events WHERE event_type = 'error')"""
VIEWS["judged"] = f"""
  SELECT *, CASE
    WHEN id IS NULL AND current_price IS NULL THEN 'Missing required fields: [''id'', ''current_price'']'
    WHEN id IS NULL THEN 'Missing required fields: [''id'']'
    WHEN current_price IS NULL THEN 'Missing required fields: [''current_price'']'
    WHEN current_price <= 0 THEN 'Invalid price: ' || CAST(current_price AS VARCHAR) END AS reason
  FROM ({VIEWS["quotes"]})"""
VIEWS["alerts"] = f"""
  SELECT "timestamp" AS alerted_at, id AS coin_id, symbol, price, change_5min,
         CASE WHEN change_5min >= 2.0 THEN 'PUMP' ELSE 'DUMP' END AS alert_type, seq
  FROM ({VIEWS["metrics_user"]}) WHERE abs(change_5min) >= 2.0"""


def using(*names: str) -> str:
    """A WITH clause over the named views."""
    return "WITH " + ",\n".join(f"{name} AS ({VIEWS[name]})" for name in names)
