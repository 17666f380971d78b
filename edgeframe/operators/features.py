"""The leakage-safe daily feature table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from edgeframe.defaults import (
    INFORMED_NOISE,
    INFORMED_SHRINK,
    INFORMED_SLOPE,
    LAKE_REQUIRED,
    NAIVE_SPREAD,
    PRICE_HI,
    PRICE_LO,
)
from edgeframe.functions.numeric import (
    clip,
    cyclic,
    hashed_normal,
    hashed_uniform,
    sigmoid,
)
from edgeframe.operators.blocks import BLOCK, day_blocks, in_block, with_history

LONGEST = 30


def lag_features(daily: DataFrame, warmup: str = "partial", block: Column | None = None) -> DataFrame:
    """Add lags and trailing means per station, looking only at earlier rows.

    ``warmup="partial"`` averages whatever rows exist; ``"full"`` gives null until the
    frame is full. Lags count rows, not days.
    """
    if warmup not in ("partial", "full"):
        raise ValueError(f"unknown warmup {warmup!r}")
    rows = daily.withColumn("date", F.to_date("date"))
    rows = rows.withColumn(BLOCK, day_blocks() if block is None else block)
    w = in_block(["station"], ["date"])

    def trailing(n: int) -> Column:
        frame = w.rowsBetween(-n, -1)
        mean = F.avg("tmax_f").over(frame)
        return mean if warmup == "partial" else F.when(F.count("tmax_f").over(frame) == n, mean)

    added = {
        "tmax_lag1": F.lag("tmax_f", 1).over(w),
        "tmax_lag2": F.lag("tmax_f", 2).over(w),
        "tmax_lag3": F.lag("tmax_f", 3).over(w),
        "tmin_lag1": F.lag("tmin_f", 1).over(w),
        "humidity_lag1": F.lag("humidity", 1).over(w),
        "wind_lag1": F.lag("wind_mph", 1).over(w),
        "tmax_roll7": trailing(7),
        "tmax_roll30": trailing(30),
    }
    return (
        with_history(rows, ["station"], ["date"], LONGEST)
        .withColumns(added)
        .where(~F.col("_seed"))
        .drop("_seed", BLOCK)
    )


def calendar_features(df: DataFrame) -> DataFrame:
    """Add day of year, month, year and the cyclic encoding of the season."""
    doy = F.dayofyear("date")
    sin, cos = cyclic(doy)
    return df.withColumns(
        {
            "doy": doy,
            "month": F.month("date"),
            "year": F.year("date"),
            "doy_sin": sin,
            "doy_cos": cos,
        }
    )


def naive_price(*keys: str) -> Column:
    """A price near one half that knows nothing, the same for the same keys."""
    u = hashed_uniform(*[F.col(k) for k in keys])
    return F.round(clip(F.lit(0.5) + (u - F.lit(0.5)) * F.lit(NAIVE_SPREAD), PRICE_LO, PRICE_HI), 4)


def informed_price(*keys: str, noise: float = INFORMED_NOISE) -> Column:
    """A price that follows the 7-day anomaly; ``noise=0`` leaves the noise out."""
    informed = sigmoid(F.lit(INFORMED_SLOPE) * (F.col("tmax_roll7") - F.col("normal_30")))
    price = F.lit(0.5) + F.lit(INFORMED_SHRINK) * (informed - F.lit(0.5))
    if noise:
        price = price + F.lit(noise) * hashed_normal(*[F.col(k) for k in keys])
    return F.round(clip(price, PRICE_LO, PRICE_HI), 4)


def contract_columns(
    df: DataFrame, pricing: str = "naive", noise: float = INFORMED_NOISE
) -> DataFrame:
    """Label, price and threshold of the above-normal contract, derived where not given.

    Decided row by row: a lake may mix sources that carry the contract with some that don't.
    """
    keys = ("station", "date")
    price = {"naive": naive_price(*keys), "informed": informed_price(*keys, noise=noise)}[pricing]
    derived = {
        "label_high": (F.col("tmax_f") > F.col("normal_30")).cast("int"),
        "market_yes_price": price,
        "threshold_f": F.round("normal_30", 2),
    }
    return df.withColumns(
        {n: F.coalesce(F.col(n), c) if n in df.columns else c for n, c in derived.items()}
    )


def build_features(
    daily: DataFrame,
    warmup: str = "partial",
    pricing: str = "naive",
    noise: float = INFORMED_NOISE,
    block: Column | None = None,
) -> DataFrame:
    """The lake's rows: lags, trailing normals, calendar, contract; warm-up rows dropped."""
    rows = calendar_features(lag_features(daily, warmup, block)).withColumns(
        {"normal_30": F.col("tmax_roll30"), "target_high_f": F.col("tmax_f")}
    )
    return contract_columns(rows, pricing, noise).dropna(subset=LAKE_REQUIRED)
