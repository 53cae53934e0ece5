"""The periodic market snapshot, one per micro-batch of new ticks."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tickloom.functions.bounds import bounds
from tickloom.functions.clock import utc_now
from tickloom.plans.served import market_snapshot


@bounds(interval_seconds=(2, 60))
def start_market_snapshots(
    ticks: DataFrame,
    tables: Callable[[], Mapping[str, DataFrame]],
    publish: Callable[[str, DataFrame, int], None],
    checkpoint: str,
    interval_seconds: int = 5,
    backfill: bool = False,
) -> StreamingQuery:
    """Give each snapshot part to ``publish`` with its name and the batch number.

    ``tables`` is asked for the metrics and run metrics anew at each batch, and for the table
    of latest rows (``latest``), without which each batch reads all metrics. A batch may be published again after a failure, under the same number.
    """

    def each(batch: DataFrame, number: int) -> None:
        served = tables()
        parts = market_snapshot(
            served["metrics"], served["run_metrics"], utc_now(), kept=served.get("latest")
        )
        for name, frame in parts.items():
            publish(name, frame, number)

    trigger = (
        {"availableNow": True} if backfill else {"processingTime": f"{interval_seconds} seconds"}
    )
    return (
        ticks.writeStream.queryName("market_snapshots")
        .foreachBatch(each)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )
