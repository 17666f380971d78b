"""Backtest of binary-contract trades over a time-ordered prediction table."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from edgeframe.defaults import (
    BANKROLL_USD,
    EDGE_THRESHOLD,
    FEE_RATE,
    KELLY_CAP,
    KELLY_FRACTION,
)
from edgeframe.functions import contracts
from edgeframe.operators.blocks import BLOCK, day_blocks, earlier_blocks, in_block

KEY, ORDER = ["market"], ["date"]


def decisions(preds: DataFrame, threshold=EDGE_THRESHOLD) -> DataFrame:
    """Add side, edge and fair price; ``threshold`` may be a number or a column."""
    return preds.withColumns(
        contracts.decide(F.col("model_prob"), F.col("market_prob"), threshold)
    )


def sizing(
    decided: DataFrame, safety=KELLY_FRACTION, cap=KELLY_CAP, bankroll=BANKROLL_USD
) -> DataFrame:
    """Add full and used Kelly fraction and the stake in dollars."""
    full = contracts.kelly_full(F.col("side"), F.col("model_prob"), F.col("market_prob"))
    return (
        decided.withColumn("kelly_full", full)
        .withColumn("kelly_used", contracts.kelly_used(F.col("kelly_full"), safety, cap))
        .withColumn("stake_usd", contracts.stake(F.col("kelly_used"), bankroll))
    )


def trades(
    preds: DataFrame,
    threshold=EDGE_THRESHOLD,
    safety=KELLY_FRACTION,
    cap=KELLY_CAP,
    bankroll=BANKROLL_USD,
    fee=FEE_RATE,
) -> DataFrame:
    """Decision, sizing and profit of every row; a row without trade has profit 0.

    The stake is a fraction of the starting bankroll, so rows are independent and equity
    is a running sum.
    """
    sized = sizing(decisions(preds, threshold), safety, cap, bankroll)
    side, used = F.col("side"), F.col("kelly_used")
    taken = (side != "PASS") & (used > 0)
    return sized.withColumns(
        {
            "taken": taken,
            "won": taken & F.coalesce(contracts.won(side, F.col("outcome")), F.lit(False)),
            "pnl": contracts.profit(
                side, used, F.col("market_prob"), F.col("outcome"), bankroll, fee
            ),
        }
    )


def equity(traded: DataFrame, bankroll=BANKROLL_USD, block: Column | None = None) -> DataFrame:
    """Add the bankroll after every row (dollars and cents), its peak so far and the drawdown.

    A first pass moves only dates and profits and yields, per block, its profit and its
    highest running profit. From these follow the bankroll and peak at which each block
    starts, and a second pass finishes every block on its own.
    """
    start = F.lit(float(bankroll))
    rows = traded.withColumn(BLOCK, day_blocks() if block is None else block)
    running = in_block(KEY, ORDER).rowsBetween(Window.unboundedPreceding, 0)
    gain = F.sum("pnl").over(running)
    # Same partitioning as the window, so the aggregation adds no shuffle.
    ends = (
        rows.select(*KEY, BLOCK, *ORDER, "pnl")
        .withColumn("_run", gain)
        .groupBy(*KEY, BLOCK)
        .agg(F.sum("pnl").alias("_gain"), F.max("_run").alias("_high"))
    )
    before = earlier_blocks(KEY)
    # Rows without a market or a date are traded too: a null key equals a null key.
    names = [*KEY, BLOCK]
    starts = ends.withColumn(
        "_base", start + F.coalesce(F.sum("_gain").over(before), F.lit(0.0))
    ).select(
        *[F.col(c).alias(f"_of_{c}") for c in names],
        "_base",
        F.max(F.round(F.col("_base") + F.col("_high"), 2)).over(before).alias("_top"),
    )
    valued = (
        rows.withColumn("_run", gain)
        .join(starts, reduce(and_, [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in names]))
        .withColumn("equity", F.round(F.col("_base") + F.col("_run"), 2))
    )
    peak = F.greatest(F.max("equity").over(running), F.col("_top"))
    return valued.withColumn("peak", peak).withColumns(
        {
            "drawdown": F.try_divide(F.col("peak") - F.col("equity"), F.col("peak")),
            "daily_return": F.col("pnl") / start,
        }
    ).drop(BLOCK, "_run", "_base", "_top", *[f"_of_{c}" for c in names])


def metrics(curve: DataFrame, bankroll=BANKROLL_USD) -> DataFrame:
    """Headline numbers of each market from the output of ``equity``."""
    start = float(bankroll)
    sums = curve.groupBy(*KEY).agg(
        F.sum(F.col("taken").cast("long")).alias("n_trades"),
        F.avg(F.when(F.col("taken"), F.col("edge"))).alias("_edge"),
        F.sum(F.col("won").cast("long")).alias("_wins"),
        F.count(F.lit(1)).alias("_days"),
        F.sum("pnl").alias("_gain"),
        F.max("drawdown").alias("_fall"),
        F.avg("daily_return").alias("_mean"),
        F.stddev_pop("daily_return").alias("_std"),
        F.min("date").alias("_first"),
        F.max("date").alias("_last"),
    )
    final = F.lit(start) + F.col("_gain")
    growth = final / F.lit(start)
    months = F.col("_days") / F.lit(30.0)
    sharpe = F.when(
        F.col("_std") > 1e-12, F.col("_mean") / F.col("_std") * F.sqrt(F.lit(252.0))
    ).otherwise(F.lit(0.0))
    return sums.select(
        *KEY,
        "n_trades",
        F.coalesce("_edge", F.lit(0.0)).alias("avg_edge"),
        F.when(F.col("n_trades") > 0, F.col("_wins") / F.col("n_trades"))
        .otherwise(F.lit(0.0))
        .alias("hit_rate"),
        F.when(growth >= 0, F.pow(growth, F.lit(1.0) / months) - F.lit(1.0)).alias("monthly_roi"),
        (growth - F.lit(1.0)).alias("total_return"),
        F.coalesce("_fall", F.lit(0.0)).alias("max_drawdown"),
        sharpe.alias("sharpe"),
        F.round(final, 2).alias("final_bankroll"),
        F.date_format("_first", "yyyy-MM-dd").alias("window_start"),
        F.date_format("_last", "yyyy-MM-dd").alias("window_end"),
    )


def run_backtest(
    preds: DataFrame,
    threshold=EDGE_THRESHOLD,
    safety=KELLY_FRACTION,
    cap=KELLY_CAP,
    bankroll=BANKROLL_USD,
    fee=FEE_RATE,
    block: Column | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(metrics per market, equity curve) of (market, date, model_prob, market_prob, outcome)."""
    traded = trades(preds, threshold, safety, cap, bankroll, fee)
    curve = equity(traded, bankroll, block)
    return metrics(curve, bankroll), curve.select(*KEY, "date", "equity")
