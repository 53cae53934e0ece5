"""Cross signals of the short and the long mean, and the trades they make.

Being in a position depends only on the sign of the last unequal pair of means, so
a row flips the position when its sign differs from the row before it among rows
with unequal means. That needs one row of look-back, and so does pairing each sale
with its purchase among the flips. All keys run in parallel.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickloom.functions.numeric import round_half_up, safe_pct
from tickloom.operators.hotkeys import (
    DEFAULT_POLICY,
    SplitPolicy,
    join_per_key,
    lookback_window,
    no_key_is_hot,
    time_cuts,
)
from tickloom.operators.ranking import latest_per_key
from tickloom.session import written

# The one strategy name, the least points, the kept actions.
STRATEGY = "ema_cross"
MIN_POINTS = 20
KEPT_ACTIONS = 10
TOO_SHORT = "Not enough points for backtest (need at least 20)."

# Means closer than this share of their size differ only by summation order.
_EQUAL_WITHIN = 1e-12


def _turned(
    signed: DataFrame, order: Sequence[str], policy: SplitPolicy, cuts: DataFrame | None
) -> DataFrame:
    """Rows that flip the position: the first +1, then every change of sign."""
    rows = lookback_window(
        signed,
        order,
        1,
        lambda w: {"_before": F.lag("side", 1).over(w)},
        policy=policy,
        cuts=cuts,
    )
    into = (F.col("side") == 1) & (F.coalesce("_before", F.lit(-1)) == -1)
    out = (F.col("side") == -1) & (F.col("_before") == 1)
    return rows.filter(into | out).drop("_before")


@dataclass(frozen=True)
class CrossRun:
    """Frames of one run: one row per key, and one row per flip."""

    series: DataFrame
    flips: DataFrame
    order: tuple[str, ...]
    policy: SplitPolicy


def cross_run(
    metrics: DataFrame,
    order: Sequence[str] = ("timestamp",),
    policy: SplitPolicy = DEFAULT_POLICY,
) -> CrossRun:
    """Series facts and position flips of priced rows. Prices are positive (validated)."""
    order = tuple(order)
    priced = metrics.filter(F.col("price").isNotNull()).select(
        *dict.fromkeys(["id", *order, "price", "sma", "ema"])
    )
    moment = F.struct(*order)
    series = priced.groupBy("id").agg(
        F.count(F.lit(1)).alias("points"),
        F.min_by("price", moment).alias("first_price"),
        F.max_by("price", moment).alias("last_price"),
        F.max(moment).alias("last_moment"),
    )

    gap = F.col("ema") - F.col("sma")
    unequal = F.abs(gap) > F.abs("sma") * _EQUAL_WITHIN
    signed = priced.filter((F.col("price") != 0) & unequal).select(
        *dict.fromkeys(["id", *order, "price"]), F.signum(gap).cast("int").alias("side")
    )
    # both look-backs use one list of cuts
    plain = no_key_is_hot(priced, policy)
    cuts = None if plain else time_cuts(priced, ["id"], order[0], policy)
    turned = _turned(signed, order, policy, cuts)
    if cuts is not None:  # then it is read twice
        turned = written(turned, "turns")
    flips = lookback_window(
        turned,
        order,
        1,
        lambda w: {
            "entry_price": F.lag("price", 1).over(w),
            "entry_time": F.lag(order[0], 1).over(w),
        },
        policy=policy,
        cuts=cuts,
    )
    # every result reads the flips, some of them twice
    flips = written(flips, "flips")
    return CrossRun(series, flips, order, policy)


def _events(run: CrossRun) -> DataFrame:
    """BUY, SELL and closing SELL_EOD rows of keys with enough points."""
    long_enough = run.series.filter(F.col("points") >= MIN_POINTS)
    flips = join_per_key(run.flips, long_enough, "points", policy=run.policy).select(
        *run.flips.columns
    )
    bought = F.col("side") == 1
    moment = [name for name in run.order if name != "price"]
    seen = flips.select(
        "id",
        *moment,
        F.lit(0).alias("closing"),
        F.when(bought, "BUY").otherwise("SELL").alias("action"),
        "price",
        F.when(~bought, F.col("entry_price")).alias("entry_price"),
        F.when(~bought, F.col("entry_time")).alias("entry_time"),
    )
    # a key whose newest flip is a purchase sells at its last row, unless that price is 0
    still_open = latest_per_key(run.flips, ["id"], run.order).filter(bought)
    closed = (
        still_open.select(
            "id", F.col("price").alias("entry_price"), F.col(run.order[0]).alias("entry_time")
        )
        .join(long_enough.filter(F.col("last_price") != 0), "id")
        .select(
            "id",
            *(F.col(f"last_moment.{name}").alias(name) for name in moment),
            F.lit(1).alias("closing"),
            F.lit("SELL_EOD").alias("action"),
            F.col("last_price").alias("price"),
            "entry_price",
            "entry_time",
        )
    )
    return seen.unionByName(closed)


def cross_trades(run: CrossRun) -> DataFrame:
    """One row per finished trade; the profit in percent leaves fees out."""
    return (
        _events(run)
        .filter(F.col("action") != "BUY")
        .select(
            "id",
            "entry_time",
            "entry_price",
            F.col(run.order[0]).alias("exit_time"),
            F.col("price").alias("exit_price"),
            round_half_up(
                safe_pct(F.col("price") - F.col("entry_price"), F.col("entry_price")), 4
            ).alias("pnl_pct"),
            F.col("action").alias("exit_action"),
        )
    )


def _growth(price: str, fee_bps: float):
    """Log of what a trade multiplies the cash by, a fee taken on both sides."""
    keep = 1.0 - fee_bps / 10_000.0
    return F.log(F.try_divide(F.col(price), F.col("entry_price")) * (keep * keep))


def cross_backtest(
    run: CrossRun, minutes: int, initial_capital: float = 1000.0, fee_bps: float = 10.0
) -> DataFrame:
    """Result of the strategy against holding, per key; short series carry an error."""
    by_key = (
        cross_trades(run)
        .withColumn("_log", _growth("exit_price", fee_bps))
        .groupBy("id")
        .agg(
            F.count(F.lit(1)).alias("n_trades"),
            F.count_if(F.col("pnl_pct") > 0).alias("wins"),
            F.sum("_log").alias("_log"),
        )
    )
    open_zero = latest_per_key(run.flips, ["id"], run.order).filter(F.col("side") == 1)
    joined = run.series.join(by_key, "id", "left").join(
        open_zero.select("id", F.lit(True).alias("_open")), "id", "left"
    )
    enough = F.col("points") >= MIN_POINTS
    capital = F.lit(float(initial_capital))
    # cash never returned from an open position leaves the initial capital as equity
    unsold = F.coalesce("_open", F.lit(False)) & (F.col("last_price") == 0)
    cash = capital * F.exp(F.coalesce("_log", F.lit(0.0)))
    equity = F.when(unsold | (cash <= 0), capital).otherwise(cash)
    gain = safe_pct(equity - capital, capital)
    hold = F.when(
        F.col("last_price") != 0,
        safe_pct(F.col("last_price") - F.col("first_price"), F.col("first_price")),
    )
    trades = F.coalesce("n_trades", F.lit(0))

    def valid(value):
        return F.when(enough, value)

    return joined.select(
        F.col("id").alias("coin_id"),
        F.lit(STRATEGY).alias("strategy"),
        F.lit(minutes).alias("window_minutes"),
        "points",
        valid(round_half_up(capital, 2)).alias("initial_capital"),
        valid(round_half_up(equity, 2)).alias("final_equity"),
        valid(round_half_up(gain, 4)).alias("strategy_return_pct"),
        valid(round_half_up(hold, 4)).alias("buy_hold_return_pct"),
        valid(round_half_up(gain - hold, 4)).alias("excess_return_pct"),
        valid(trades).alias("trades"),
        valid(round_half_up(safe_pct(F.coalesce("wins", F.lit(0)), trades), 2)).alias(
            "win_rate_pct"
        ),
        F.when(~enough, TOO_SHORT).alias("error"),
    )


def cross_actions(
    run: CrossRun, initial_capital: float = 1000.0, fee_bps: float = 10.0
) -> DataFrame:
    """The last actions of each key, with the bought quantity.

    The cash of a purchase is the final cash less the growth of the trades that end
    after it, and those are among the kept actions.
    """
    logged = _events(run).withColumn(
        "_log", F.when(F.col("action") != "BUY", _growth("price", fee_bps)).otherwise(0.0)
    )
    ordered = [*run.order, "closing"]
    kept = latest_per_key(logged, ["id"], ordered, KEPT_ACTIONS)
    total = logged.groupBy("id").agg(F.sum("_log").alias("_total"))
    after = Window.partitionBy("id").orderBy(*ordered).rowsBetween(1, Window.unboundedFollowing)
    cash = F.lit(float(initial_capital)) * F.exp(F.col("_total") - F.col("_after"))
    quantity = F.try_divide(cash, F.col("price")) * (1.0 - fee_bps / 10_000.0)
    return (
        kept.withColumn("_after", F.coalesce(F.sum("_log").over(after), F.lit(0.0)))
        .join(total, "id")
        .select(
            "id",
            F.col(run.order[0]).alias("time"),
            "action",
            "price",
            F.when(F.col("action") == "BUY", quantity).alias("qty"),
        )
    )
