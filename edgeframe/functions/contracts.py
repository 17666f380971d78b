"""Trade decision, sizing and profit of a binary contract, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from edgeframe.defaults import (
    BANKROLL_USD,
    EDGE_THRESHOLD,
    FEE_RATE,
    KELLY_CAP,
    KELLY_FRACTION,
)
from edgeframe.functions.numeric import probability


def _col(x) -> Column:
    return x if isinstance(x, Column) else F.lit(x)


def blend(first: Column, second: Column, weight=0.5) -> Column:
    """Convex mix of two probabilities, kept away from 0 and 1."""
    w = F.least(F.greatest(_col(weight), F.lit(0.0)), F.lit(1.0))
    return probability(w * first + (F.lit(1.0) - w) * second)


def decide(model_prob: Column, market_prob: Column, threshold=EDGE_THRESHOLD) -> dict[str, Column]:
    """Side, its edge and the fair YES price; PASS where a probability is missing."""
    threshold = _col(threshold)
    p, q = probability(model_prob), probability(market_prob)
    yes, no = p - q, q - p
    side = (
        F.when((yes >= no) & (yes > threshold), "YES")
        .when(no > threshold, "NO")
        .otherwise("PASS")
    )
    edge = F.when(side == "YES", yes).when(side == "NO", no).otherwise(F.lit(0.0))
    return {"side": side, "edge": edge, "fair_yes_price": p}


def kelly_full(side: Column, model_prob: Column, market_prob: Column) -> Column:
    """Growth-optimal fraction of the bankroll for the chosen side, never negative."""
    p, q = probability(model_prob), probability(market_prob)
    fraction = F.when(side == "YES", (p - q) / (F.lit(1.0) - q)).when(side == "NO", (q - p) / q)
    return F.greatest(F.coalesce(fraction, F.lit(0.0)), F.lit(0.0))


def kelly_used(full: Column, safety=KELLY_FRACTION, cap=KELLY_CAP) -> Column:
    return F.least(full * _col(safety), _col(cap))


def stake(used: Column, bankroll=BANKROLL_USD) -> Column:
    return F.round(used * _col(bankroll), 2)


def won(side: Column, outcome: Column) -> Column:
    return ((side == "YES") & (outcome == 1)) | ((side == "NO") & (outcome == 0))


def profit(
    side: Column,
    used: Column,
    market_prob: Column,
    outcome: Column,
    bankroll=BANKROLL_USD,
    fee=FEE_RATE,
) -> Column:
    """Dollars won or lost by staking ``used`` of the starting bankroll, after fees."""
    q = probability(market_prob)
    amount = used * _col(bankroll)
    odds = F.when(side == "YES", (F.lit(1.0) - q) / q).otherwise(q / (F.lit(1.0) - q))
    gross = F.when(won(side, outcome), amount * odds).otherwise(-amount)
    traded = (side != "PASS") & (used > 0)
    return F.when(traded, gross - amount * _col(fee)).otherwise(F.lit(0.0))
