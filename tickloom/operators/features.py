"""Row-lag changes, moving means and volatility per key."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tickloom.functions.numeric import safe_pct
from tickloom.operators.hotkeys import DEFAULT_POLICY, SplitPolicy, lookback_window
from tickloom.operators.ranking import latest_per_key
from tickloom.schemas import METRIC_COLUMNS

# Row distances of the changes and row counts of the frames.
CHANGE_LAGS = {"change_1min": 1, "change_5min": 5}
MEAN_ROWS = {"sma": 5, "ema": 3}
DEVIATION_ROWS = {"volatility": 5}
CHANGE_PLACES = 2

LOOKBACK = max(
    *CHANGE_LAGS.values(),
    *(rows - 1 for rows in (*MEAN_ROWS.values(), *DEVIATION_ROWS.values())),
)


def _change(rows_back: int, w: WindowSpec) -> Column:
    past = F.lag("price", rows_back).over(w)
    return F.round(safe_pct(F.col("price") - past, past), CHANGE_PLACES)


def feature_columns(w: WindowSpec) -> Mapping[str, Column]:
    """All features over one ordered window, so that they share one sort."""
    changes = {name: _change(back, w) for name, back in CHANGE_LAGS.items()}
    means = {
        name: F.avg("price").over(w.rowsBetween(1 - rows, 0)) for name, rows in MEAN_ROWS.items()
    }
    deviations = {
        name: F.stddev_samp("price").over(w.rowsBetween(1 - rows, 0))
        for name, rows in DEVIATION_ROWS.items()
    }
    return {**changes, **means, **deviations}


def features(
    ticks: DataFrame,
    order: Sequence[str] = ("timestamp",),
    policy: SplitPolicy = DEFAULT_POLICY,
    cuts: DataFrame | None = None,
) -> DataFrame:
    """Metrics rows, one per tick. Columns of ``order`` settle equal times."""
    kept = dict.fromkeys(["id", "symbol", *order, "price"])
    rows = lookback_window(
        ticks.select(*kept), order, LOOKBACK, feature_columns, policy=policy, cuts=cuts
    )
    ties = [name for name in order if name not in METRIC_COLUMNS]
    return rows.select(*METRIC_COLUMNS, *ties)


def latest_features(ticks: DataFrame, order: Sequence[str] = ("timestamp",)) -> DataFrame:
    """The metrics of each key's last tick only.

    They read no more than the key's last few ticks, so every input split is cut to
    those before the shuffle, and a busy key costs as little as a quiet one.
    """
    kept = dict.fromkeys(["id", "symbol", *order, "price"])
    tail = latest_per_key(ticks.select(*kept), order=order, n=LOOKBACK + 1)
    w = Window.partitionBy("id").orderBy(*order)
    last = tail.withColumns({**feature_columns(w), "_next": F.lead(F.lit(1)).over(w)})
    return last.filter(F.col("_next").isNull()).select(*METRIC_COLUMNS)
