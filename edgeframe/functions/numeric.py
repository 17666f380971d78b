"""Null-safe scalar column functions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from edgeframe.defaults import FORECAST_STD_F, PROB_FLOOR

# Coefficients of Acklam's rational approximation of the inverse normal CDF.
ACKLAM_A = [
    -3.969683028665376e01, 2.209460984245205e02, -2.759285104469687e02,
    1.383577518672690e02, -3.066479806614716e01, 2.506628277459239e00,
]
ACKLAM_B = [
    -5.447609879822406e01, 1.615858368580409e02, -1.556989798598866e02,
    6.680131188771972e01, -1.328068155288572e01, 1.0,
]
ACKLAM_C = [
    -7.784894002430293e-03, -3.223964580411365e-01, -2.400758277161838e00,
    -2.549732539343734e00, 4.374664141464968e00, 2.938163982698783e00,
]
ACKLAM_D = [
    7.784695709041462e-03, 3.224671290700398e-01, 2.445134137142996e00,
    3.754408661907416e00, 1.0,
]
ACKLAM_LOW = 0.02425


def number(x: Column) -> Column:
    """``x``, with NaN turned into null."""
    return F.when(~F.isnan(x), x)


def clip(x: Column, lo: float, hi: float) -> Column:
    """``x`` limited to [lo, hi]; null and NaN give null rather than a bound."""
    return F.when(x.isNotNull() & ~F.isnan(x), F.least(F.greatest(x, F.lit(lo)), F.lit(hi)))


def probability(x: Column, floor: float = PROB_FLOOR) -> Column:
    return clip(x, floor, 1 - floor)


def logit(p: Column, floor: float = 1e-6) -> Column:
    p = probability(p, floor)
    return F.ln(p / (F.lit(1.0) - p))


def sigmoid(x: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-x))


def cyclic(doy: Column, days: float = 365.0) -> tuple[Column, Column]:
    """Sine and cosine of the position in the year."""
    angle = F.lit(2 * math.pi) * doy / F.lit(days)
    return F.sin(angle), F.cos(angle)


def mid(bid: Column, ask: Column) -> Column:
    return (bid + ask) / F.lit(2.0)


def percent(x: Column, digits: int = 2) -> Column:
    """``x`` as percent text, "-" where there is no number."""
    text = F.concat(F.format_string(f"%.{digits}f", number(x) * F.lit(100.0)), F.lit("%"))
    return F.when(number(x).isNotNull(), text).otherwise("-")


def _poly(coefficients: list[float], x: Column) -> Column:
    value = F.lit(coefficients[0])
    for c in coefficients[1:]:
        value = value * x + F.lit(c)
    return value


def inverse_normal(p: Column) -> Column:
    """Quantile of the standard normal distribution for p in (0, 1)."""
    tail = F.sqrt(F.lit(-2.0) * F.ln(F.least(p, F.lit(1.0) - p)))
    outer = _poly(ACKLAM_C, tail) / _poly(ACKLAM_D, tail)
    centred = p - F.lit(0.5)
    square = centred * centred
    inner = _poly(ACKLAM_A, square) * centred / _poly(ACKLAM_B, square)
    return (
        F.when(p < ACKLAM_LOW, outer)
        .when(p > 1 - ACKLAM_LOW, -outer)
        .otherwise(inner)
    )


def point_estimate(p: Column, threshold: Column, std: float = FORECAST_STD_F) -> Column:
    """The value whose chance of exceeding ``threshold`` is ``p`` under a normal error."""
    return threshold + F.lit(std) * inverse_normal(probability(p, 1e-3))


def hashed_uniform(*keys: Column, part: int = 0) -> Column:
    """A uniform number in [0, 1) that depends on the key values only.

    Unlike ``rand`` it does not change with the partitioning or when a task is run again.
    ``part`` 0 or 1 gives two independent numbers.
    """
    digest = F.md5(F.concat_ws("|", *[k.cast("string") for k in keys]))
    digits = F.substring(digest, 1 + 13 * part, 13)
    return F.conv(digits, 16, 10).cast("double") / F.lit(float(2**52))


def hashed_normal(*keys: Column) -> Column:
    """A standard normal number that depends on the key values only (Box-Muller)."""
    radius = F.sqrt(F.lit(-2.0) * F.ln(F.lit(1.0) - hashed_uniform(*keys)))
    return radius * F.cos(F.lit(2 * math.pi) * hashed_uniform(*keys, part=1))
