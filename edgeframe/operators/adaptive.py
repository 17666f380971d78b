"""Adaptive search for blend weight and edge threshold, all markets at once.

A trial is a full backtest of the validation rows. After some spread-out trials, each round
splits a market's trials into the best seventh and the rest, puts a Parzen density over either and
tries points where the first is high against the second. A round is one job over all markets;
only the trials, a few dozen rows a market, come together in one task.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from edgeframe.defaults import EDGE_THRESHOLD, THRESHOLD_HI, THRESHOLD_LO
from edgeframe.operators.search import DEFAULT_SIZES, Sizes, best_candidates, score_candidates
from edgeframe.storage import cut

METHOD = "adaptive-parzen"
TRIALS, SPREAD, ROUND = 40, 16, 6
#: Share of the trials that count as good, points weighed per proposal, kernel widths allowed.
GOOD, WEIGHED, WIDTHS = 0.15, 96, (0.015, 0.15)
_LOW = np.array([0.0, THRESHOLD_LO])
_HIGH = np.array([1.0, THRESHOLD_HI])


def _spread(rng: np.random.Generator, count: int) -> np.ndarray:
    """The default parameters, then one point in each row and each column of a grid."""
    cells = np.stack([rng.permutation(count), rng.permutation(count)], axis=1)
    points = (cells + rng.random((count, 2))) / count
    points[0] = (np.array([0.5, EDGE_THRESHOLD]) - _LOW) / (_HIGH - _LOW)
    return points


def _density(x: np.ndarray, centres: np.ndarray, width: np.ndarray) -> np.ndarray:
    """Mean of normal kernels and of one even one, which keeps all of the square possible."""
    off = ((x[:, None, :] - centres[None, :, :]) / width[None, :, None]) ** 2
    kernels = np.exp(-0.5 * off.sum(axis=2)) / (2 * np.pi * width**2)
    return (kernels.sum(axis=1) + 1.0) / (len(centres) + 1)


def _widths(points: np.ndarray) -> np.ndarray:
    """Distance of each point to its second neighbour: narrow where trials are dense."""
    far = np.sqrt(((points[:, None] - points[None]) ** 2).sum(axis=2))
    return np.clip(np.sort(far, axis=1)[:, min(2, len(points) - 1)], *WIDTHS)


def propose(
    points: np.ndarray, scores: np.ndarray, count: int, rng: np.random.Generator
) -> np.ndarray:
    """``count`` points of the unit square to try next.

    Each proposal joins the poor points at once, so that those of a round lie apart.
    """
    order = np.lexsort((points[:, 1], points[:, 0], -scores))
    points = points[order]
    widths = _widths(points)
    n_good = max(2, int(np.ceil(GOOD * len(points))))
    good, good_width = points[:n_good], widths[:n_good]
    poor, poor_width = points[n_good:], widths[n_good:]
    found = []
    for _ in range(count):
        at = rng.integers(0, len(good), WEIGHED)
        drawn = good[at] + rng.standard_normal((WEIGHED, 2)) * good_width[at, None]
        # What falls outside is mirrored at the border.
        drawn = np.abs(drawn) % 2.0
        drawn = np.where(drawn > 1.0, 2.0 - drawn, drawn)
        gain = _density(drawn, good, good_width) / _density(drawn, poor, poor_width)
        chosen = drawn[np.argmax(gain)]
        found.append(chosen)
        poor = np.vstack([poor, chosen])
        poor_width = np.append(poor_width, WIDTHS[0] * 2)
    return np.array(found).reshape(-1, 2)


def _proposals(count: int, seed: int, turn: int):
    def run(key: tuple, trials: pa.Table) -> pa.Table:
        market = key[0].as_py()
        # The name, not the row order, decides what is drawn; a null market has a name of its own.
        rng = np.random.default_rng([seed, zlib.crc32(repr(market).encode()), turn])
        if turn == 0:
            points = _spread(rng, count)
        else:
            tried = np.stack(
                [trials["weight"].to_numpy(), trials["threshold"].to_numpy()], axis=1
            )
            scores = np.nan_to_num(trials["score"].to_numpy(), nan=-np.inf)
            points = propose((tried - _LOW) / (_HIGH - _LOW), scores, count, rng)
        points = _LOW + points * (_HIGH - _LOW)
        return pa.table(
            {
                "market": pa.array([market] * count, trials["market"].type),
                "weight": pa.array(points[:, 0]),
                "threshold": pa.array(points[:, 1]),
            }
        )

    return run


def trials_of(
    markets: DataFrame,
    score: Callable[[DataFrame], DataFrame],
    trials: int = TRIALS,
    spread: int = SPREAD,
    batch: int = ROUND,
    seed: int = 17,
) -> DataFrame:
    """All trials (``market``, ``weight``, ``threshold``, ``score``) of each market.

    ``score`` takes (market, weight, threshold) rows and gives the same rows with their score;
    the higher, the better. The same seed gives the same trials.
    """
    spread = min(spread, trials)
    if spread < 3:
        raise ValueError("an adaptive search needs three trials to learn from")
    names = ["market", "weight", "threshold", "score"]
    schema = T.StructType(
        [markets.schema["market"]]
        + [T.StructField(c, T.DoubleType()) for c in ("weight", "threshold")]
    )
    done, turn, made = None, 0, 0
    while made < trials:
        count = spread if done is None else min(batch, trials - made)
        known = markets.select("market").distinct() if done is None else done
        # Proposals are drawn once; the scores and later rounds read what was drawn.
        tried = cut(
            known.groupBy("market").applyInArrow(_proposals(count, seed, turn), schema)
        )
        scored = score(tried).select(*names)
        done = cut(scored if done is None else done.unionByName(scored))
        turn, made = turn + 1, made + count
    return done


def adaptive_search(
    preds: DataFrame,
    trials: int = TRIALS,
    seed: int = 17,
    block: Column | None = None,
    sizes: Sizes = DEFAULT_SIZES,
) -> DataFrame:
    """Best of ``trials`` adaptive trials of each market.

    Every round reads ``preds`` anew, so give a stored table. The default parameters are always
    among the trials. A null market is a market; a market without rows does not appear.
    """
    done = trials_of(
        preds, lambda tried: score_candidates(preds, tried, block, sizes), trials, seed=seed
    )
    return best_candidates(done, METHOD).where(F.col("score").isNotNull())
