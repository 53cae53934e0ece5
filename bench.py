"""Time the headline queries; prints one JSON line.

Reads ``BENCH_SF_DIR`` on ``local[BENCH_CPUS]``. Served queries read a metrics table
that is written first (its own entry), as the batch run leaves it.
"""

from __future__ import annotations

import inspect
import json
import os
import sys
import time
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession

from tickloom.operators import anomalies, candles, features, ranking
from tickloom.plans import served
from tickloom.registry import views as v
from tickloom.session import RECOMMENDED, written

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 4))


def session() -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
    )
    for key, value in RECOMMENDED.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def run(frame: DataFrame) -> None:
    """Compute every row and column, and keep none."""
    frame.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = session()
    items = v.ticks_item(spark, SF_DIR)
    order = v.ITEM_ORDER
    everything = 20 * 365 * 24 * 60
    run(items)  # start-up, file listing, first compilation

    took: dict[str, float] = {}

    def timed(name: str, build):
        best = None
        for _ in range(3):
            start = time.perf_counter()
            result = build()
            spent = time.perf_counter() - start
            best = spent if best is None else min(best, spent)
        took[name] = round(best, 3)
        return result

    timed("features", lambda: run(features.features(items, order)))
    timed("ohlc", lambda: run(candles.candles(items, timedelta(days=1), order)))
    timed("latest_per_coin", lambda: run(features.latest_features(items, order)))
    timed(
        "top_gainers",
        lambda: run(ranking.top_gainers(features.latest_features(items, order))),
    )
    metrics = timed(
        "write_metrics", lambda: written(features.features(items, order), "bench-metrics")
    )
    timed("anomalies", lambda: run(anomalies.anomalous(metrics, 2.0)))
    wide = inspect.unwrap(served.pair_corr)
    timed(
        "pair_corr",
        lambda: run(wide(v.aligned(spark, SF_DIR), v.TYPES, v.AS_OF, v.ALL_MINUTES)),
    )
    backtest = inspect.unwrap(served.backtest)
    timed(
        "cross_backtest",
        lambda: run(backtest(metrics, v.AS_OF, everything, order=order)["result"]),
    )

    print(
        json.dumps(
            {
                "metric": "headline queries, sum of best times",
                "value": round(sum(took.values()), 3),
                "unit": "sec",
                "queries": took,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    sys.stdout.flush()
    spark.stop()


if __name__ == "__main__":
    main()
