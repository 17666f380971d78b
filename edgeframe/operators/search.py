"""Search for the blend weight and edge threshold of each market.

Every candidate is a full backtest of the validation rows. The rows are shuffled once by
(market, block) and never multiplied by the candidates: a task takes one bounded block and
scores all candidates on it as array columns. Two passes over the same shuffle are needed,
since a block's drawdown depends on the equity at which the block starts.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from edgeframe.defaults import (
    BANKROLL_USD,
    EDGE_THRESHOLD,
    FEE_RATE,
    KELLY_CAP,
    KELLY_FRACTION,
    MIN_TRADES,
    N_THRESHOLDS,
    N_WEIGHTS,
    PROB_FLOOR,
    THRESHOLD_HI,
    THRESHOLD_LO,
)
from edgeframe.operators.blocks import BLOCK, day_blocks
from edgeframe.schemas import record
from edgeframe.storage import cut

PREDICTIONS = ["market", "date", "lstm_prob", "transformer_prob", "market_prob", "outcome"]


def grid(
    n_weights: int = N_WEIGHTS,
    n_thresholds: int = N_THRESHOLDS,
    weights: tuple[float, float] = (0.0, 1.0),
    thresholds: tuple[float, float] = (THRESHOLD_LO, THRESHOLD_HI),
) -> list[tuple[float, float]]:
    """(weight, threshold) pairs of an even grid, weights outermost."""
    return [
        (float(w), float(t))
        for w in np.linspace(*weights, n_weights)
        for t in np.linspace(*thresholds, n_thresholds)
    ]


@dataclass(frozen=True)
class Sizes:
    """How a trade is sized and charged; the same rule as ``functions.contracts``."""

    safety: float = KELLY_FRACTION
    cap: float = KELLY_CAP
    bankroll: float = BANKROLL_USD
    fee: float = FEE_RATE


DEFAULT_SIZES = Sizes()


def _profits(rows: pa.Table, weight: np.ndarray, threshold: np.ndarray, sizes: Sizes):
    """(profit, traded) of each row (down, by date) for each candidate (across)."""

    def clipped(x):
        return np.clip(x, PROB_FLOOR, 1 - PROB_FLOOR)

    order = np.argsort(rows["date"].to_numpy(), kind="stable")
    first, second, market, outcome = (
        rows[c].to_numpy().astype(float)[order][:, None]
        for c in ("lstm_prob", "transformer_prob", "market_prob", "outcome")
    )
    q = clipped(market)
    p = clipped(weight * first + (1.0 - weight) * second)
    gap = p - q
    yes = gap > 0
    # NaN compares false, so a row without a probability is not traded.
    traded = np.abs(gap) > threshold
    used = np.minimum(np.where(yes, gap / (1.0 - q), -gap / q) * sizes.safety, sizes.cap)
    traded &= used > 0
    stake = used * sizes.bankroll
    odds = np.where(yes, (1.0 - q) / q, q / (1.0 - q))
    won = np.where(yes, outcome == 1, outcome == 0)
    profit = np.where(won, stake * odds, -stake) - stake * sizes.fee
    return np.where(traded, profit, 0.0), traded


def _cents(x: np.ndarray) -> np.ndarray:
    return np.floor(x * 100.0 + 0.5) / 100.0


_KEY = ["market", BLOCK]
_TOTALS = record(
    market="string", **{BLOCK: "long"}, weight="double", threshold="double", trades="long",
    gain="double", high="double",
)
_FALLS = record(
    market="string", **{BLOCK: "long"}, weight="double", threshold="double", trades="long",
    gain="double", fall="double",
)


def _totals(rows: pa.Table, candidates: pa.Table, sizes: Sizes) -> pa.Table:
    """Per candidate: trades, profit and highest running profit of one block."""
    profit, traded = _profits(
        rows, candidates["weight"].to_numpy(), candidates["threshold"].to_numpy(), sizes
    )
    return (
        candidates.select([*_KEY, "weight", "threshold"])
        .append_column("trades", pa.array(traded.sum(axis=0, dtype=np.int64)))
        .append_column("gain", pa.array(profit.sum(axis=0)))
        .append_column("high", pa.array(np.cumsum(profit, axis=0).max(axis=0)))
    )


def _falls(rows: pa.Table, candidates: pa.Table, sizes: Sizes) -> pa.Table:
    """Per candidate: deepest drawdown of one block that starts at ``base`` below ``peak``."""
    profit, _ = _profits(
        rows, candidates["weight"].to_numpy(), candidates["threshold"].to_numpy(), sizes
    )
    value = _cents(candidates["base"].to_numpy() + np.cumsum(profit, axis=0))
    # Before the first block there is no peak; null arrives as NaN, which fmax passes over.
    peak = np.fmax(np.maximum.accumulate(value, axis=0), candidates["peak"].to_numpy())
    fall = np.divide(peak - value, peak, out=np.zeros_like(peak), where=peak != 0)
    return candidates.select([*_KEY, "weight", "threshold", "trades", "gain"]).append_column(
        "fall", pa.array(fall.max(axis=0))
    )


def score_candidates(
    preds: DataFrame,
    candidates: DataFrame | list[tuple[float, float]],
    block: Column | None = None,
    sizes: Sizes = DEFAULT_SIZES,
) -> DataFrame:
    """Trades, return, drawdown and score of every candidate on every market.

    ``candidates`` is a list used for all markets, or a table (market, weight, threshold).
    """
    rows = preds.select(*PREDICTIONS).withColumn(
        BLOCK, (day_blocks() if block is None else block).cast("long")
    )
    # Fresh column names of the same rows, so that the two sides can be told apart.
    places = rows.select(*[F.col(k).alias(k) for k in _KEY]).distinct()
    if isinstance(candidates, list):
        pairs = F.array(
            *[
                F.struct(F.lit(w).alias("weight"), F.lit(t).alias("threshold"))
                for w, t in candidates
            ]
        )
        tried = places.select(*_KEY, F.inline(pairs))
    else:
        named = candidates.withColumnRenamed("market", "_m")
        same = F.col("market").eqNullSafe(F.col("_m"))
        tried = places.join(named, same).select(*_KEY, "weight", "threshold")
    by_block = rows.groupBy(*_KEY)
    totals = by_block.cogroup(tried.groupBy(*_KEY)).applyInArrow(
        lambda rows, tried: _totals(rows, tried, sizes), _TOTALS
    )
    earlier = (
        Window.partitionBy("market", "weight", "threshold")
        .orderBy(BLOCK)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    based = totals.withColumn(
        "base",
        F.lit(float(sizes.bankroll)) + F.coalesce(F.sum("gain").over(earlier), F.lit(0.0)),
    )
    based = based.withColumn(
        "peak", F.max(F.floor((F.col("base") + F.col("high")) * 100 + 0.5) / 100).over(earlier)
    )
    falls = by_block.cogroup(based.groupBy(*_KEY)).applyInArrow(
        lambda rows, tried: _falls(rows, tried, sizes), _FALLS
    )
    scored = falls.groupBy("market", "weight", "threshold").agg(
        F.sum("trades").alias("n_trades"),
        (F.sum("gain") / F.lit(float(sizes.bankroll))).alias("total_return"),
        F.max("fall").alias("max_drawdown"),
    )
    return scored.withColumn(
        "score", objective(F.col("n_trades"), F.col("total_return"), F.col("max_drawdown"))
    )


def objective(n_trades: Column, total_return: Column, max_drawdown: Column) -> Column:
    """Return less half the drawdown; a penalty where there were too few trades."""
    return F.when(
        n_trades < MIN_TRADES, F.lit(-1.0) + F.lit(0.001) * n_trades
    ).otherwise(total_return - F.lit(0.5) * max_drawdown)


def best_candidates(scores: DataFrame, method: str = "grid-search") -> DataFrame:
    """The highest score of each market; equal scores go to the lower weight, then threshold."""
    best = F.min_by(
        F.struct("weight", "threshold", "score"),
        F.struct(-F.col("score"), "weight", "threshold"),
    )
    return scores.groupBy("market").agg(best.alias("b")).select(
        "market",
        F.col("b.weight").alias("weight_lstm"),
        F.col("b.threshold").alias("edge_threshold"),
        F.col("b.score").alias("score"),
        F.lit(method).alias("opt_method"),
    )


def default_params(markets: DataFrame) -> DataFrame:
    """The parameters used where nothing was searched."""
    return markets.select("market").distinct().select(
        "market",
        F.lit(0.5).alias("weight_lstm"),
        F.lit(EDGE_THRESHOLD).alias("edge_threshold"),
        F.lit(-1e9).alias("score"),
        F.lit("default").alias("opt_method"),
    )


def grid_search(
    preds: DataFrame, block: Column | None = None, sizes: Sizes = DEFAULT_SIZES
) -> DataFrame:
    """Best grid point of each market."""
    return best_candidates(score_candidates(preds, grid(), block, sizes))


def refined_search(
    preds: DataFrame,
    rounds: int = 3,
    side: int = 5,
    block: Column | None = None,
    sizes: Sizes = DEFAULT_SIZES,
) -> DataFrame:
    """Grid search followed by ever finer grids around each market's best point.

    The box shrinks to one grid step around the best point in each round, and the best
    point stays a candidate, so a round never lowers the score.
    """
    best = cut(best_candidates(score_candidates(preds, grid(), block, sizes), "grid-refine"))
    half_w = 1.0 / (N_WEIGHTS - 1)
    half_t = (THRESHOLD_HI - THRESHOLD_LO) / (N_THRESHOLDS - 1)
    for _ in range(rounds - 1):
        steps = [float(s) for s in np.linspace(-1.0, 1.0, side)]
        offsets = F.array(
            *[F.struct(F.lit(a).alias("w"), F.lit(b).alias("t")) for a in steps for b in steps]
        )
        weight = F.col("weight_lstm") + F.col("o.w") * F.lit(half_w)
        threshold = F.col("edge_threshold") + F.col("o.t") * F.lit(half_t)
        around = (
            best.withColumn("o", F.explode(offsets))
            .select(
                "market",
                F.least(F.greatest(weight, F.lit(0.0)), F.lit(1.0)).alias("weight"),
                F.least(
                    F.greatest(threshold, F.lit(THRESHOLD_LO)), F.lit(THRESHOLD_HI)
                ).alias("threshold"),
            )
            .distinct()
        )
        best = cut(best_candidates(score_candidates(preds, around, block, sizes), "grid-refine"))
        half_w, half_t = 2 * half_w / (side - 1), 2 * half_t / (side - 1)
    return best
