"""Platt calibration per market: two parameters fitted with a pull toward the identity."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from edgeframe.defaults import PLATT_REG
from edgeframe.functions.numeric import logit, sigmoid
from edgeframe.storage import staged

#: Shares of a Newton step that one pass tries, besides staying.
SHARES = [1.0, 0.5, 0.25, 1 / 16, 1 / 256]
#: Largest gradient of the mean loss that counts as zero.
TOLERANCE = 1e-10
#: A larger gradient than this, where no step gets any further, is an error.
FAILED = 1e-6
#: Times in a row that a step is shortened before a key counts as finished.
TRIES = 4


def fit_platt(
    preds: DataFrame,
    prob: str = "model_prob",
    outcome: str = "outcome",
    keys: Sequence[str] = ("market",),
    reg: float = PLATT_REG,
    tolerance: float = TOLERANCE,
) -> DataFrame:
    """(a, b) per key that minimise the penalised log loss of sigmoid(a * logit(p) + b).

    Damped Newton steps: a pass is one aggregation that is reduced map-side and yields, for
    every key, the derivatives at several shares of the last step. The loss is strictly convex,
    so the share with the smallest gradient is taken, and a step that no share improves is tried
    again, shorter. Passes go on, over the rows of unfinished keys only, until the gradient of every
    key is zero within ``tolerance`` or the rounding of its sums; a key that gets no further
    with a gradient above ``FAILED``, or without a number for one, is an error.

    Null keys are keys like others. Rows without probability or outcome are left out; a key with
    no other rows has no fit.
    """
    keys = list(keys)
    rows = preds.select(
        *keys, logit(F.col(prob)).alias("_z"), F.col(outcome).cast("double").alias("_y")
    ).dropna(subset=["_z", "_y"])
    rows = staged(rows, "calibration-rows")
    zero = F.lit(0.0)
    state = {"a": F.lit(1.0), "b": zero, "_da": zero, "_db": zero, "_stays": F.lit(0)}
    at = staged(rows.select(*keys).distinct().withColumns(state), "calibration-0")
    finished = []
    while True:
        # One job: the sums of a pass and the next points, written once and read again.
        moved = staged(_step(rows, at, keys, reg, tolerance), "calibration-pass")
        finished.append(moved.where(~F.col("_open")))
        left, failed = moved.agg(
            F.count_if(F.col("_open")), F.count_if(~F.col("_open") & ~(F.col("_steep") <= FAILED))
        ).first()
        if failed:
            raise ValueError(f"{failed} of the keys {keys} cannot be calibrated: no step lowers the gradient")
        if not left:
            break
        at = moved.where("_open").drop("_open", "_steep")
    result = finished[0]
    for more in finished[1:]:
        result = result.unionByName(more)
    return result.select(*keys, "a", "b")


def _same(keys: Sequence[str]) -> Column:
    """Equal keys, null to null; the right side's are named with ``_of_``."""
    found = F.lit(True)
    for key in keys:
        found = found & F.col(key).eqNullSafe(F.col(f"_of_{key}"))
    return found


def _renamed(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.withColumnsRenamed({k: f"_of_{k}" for k in keys})


def _step(
    rows: DataFrame, at: DataFrame, keys: list[str], reg: float, tolerance: float
) -> DataFrame:
    shares = [0.0, *SHARES]
    z = F.col("_z")

    def point(share: float) -> tuple[Column, Column]:
        return F.col("a") - share * F.col("_da"), F.col("b") - share * F.col("_db")

    names = [f"_of_{k}" for k in keys]
    # One row per key: broadcast by Spark while it is small, and split by it if not.
    scored = rows.join(_renamed(at, keys), _same(keys)).drop(*names)
    for i, share in enumerate(shares):
        a, b = point(share)
        scored = scored.withColumn(f"_p{i}", sigmoid(a * z + b))
    sums = []
    for i in range(len(shares)):
        p = F.col(f"_p{i}")
        miss, slope = p - F.col("_y"), p * (F.lit(1.0) - p)
        terms = {"ga": miss * z, "gb": miss, "haa": slope * z * z, "hab": slope * z, "hbb": slope}
        sums += [F.avg(term).alias(f"_{name}{i}") for name, term in terms.items()]
    found = scored.groupBy(*keys).agg(
        *[F.max(c).alias(c) for c in ("a", "b", "_da", "_db", "_stays")],
        (F.lit(reg) / F.count(F.lit(1))).alias("_r"),
        # Sums of n terms of this mean size cannot tell smaller gradients from zero.
        (F.lit(4e-16) * F.avg(F.abs(z) + 1) * F.sqrt(F.count(F.lit(1)))).alias("_rounding"),
        *sums,
    )

    def candidate(i: int) -> Column:
        a, b = point(shares[i])
        ga = F.col(f"_ga{i}") + F.col("_r") * (a - F.lit(1.0))
        gb = F.col(f"_gb{i}") + F.col("_r") * b
        return F.struct(
            F.greatest(F.abs(ga), F.abs(gb)).alias("steep"), F.lit(-shares[i]).alias("share"),
            a.alias("a"), b.alias("b"), ga.alias("ga"), gb.alias("gb"),
            (F.col(f"_haa{i}") + F.col("_r")).alias("haa"), F.col(f"_hab{i}").alias("hab"),
            (F.col(f"_hbb{i}") + F.col("_r")).alias("hbb"),
        )

    best = found.withColumn("_p", F.array_min(F.array(*[candidate(i) for i in range(len(shares))])))
    p = F.col("_p")
    det = p["haa"] * p["hbb"] - p["hab"] * p["hab"]
    # No share was better than staying: the step is tried again, shorter.
    stayed = ((F.col("_da") != 0) | (F.col("_db") != 0)) & (p["share"] == 0)
    stays = F.when(stayed, F.col("_stays") + 1).otherwise(F.lit(0))
    steep = p["steep"] > F.greatest(F.lit(tolerance), F.col("_rounding"))
    shorter = F.lit(SHARES[-1] / 2)
    da = (p["hbb"] * p["ga"] - p["hab"] * p["gb"]) / det
    db = (p["haa"] * p["gb"] - p["hab"] * p["ga"]) / det
    return best.select(
        *keys,
        p["a"].alias("a"),
        p["b"].alias("b"),
        F.when(stayed, F.col("_da") * shorter).otherwise(da).alias("_da"),
        F.when(stayed, F.col("_db") * shorter).otherwise(db).alias("_db"),
        stays.alias("_stays"),
        p["steep"].alias("_steep"),
        (steep & ~F.isnan(p["steep"]) & (stays < TRIES)).alias("_open"),
    )


def calibrated(prob: Column, a: Column, b: Column) -> Column:
    return sigmoid(a * logit(prob) + b)


def apply_platt(
    preds: DataFrame,
    fitted: DataFrame,
    prob: str = "model_prob",
    keys: Sequence[str] = ("market",),
) -> DataFrame:
    """Replace ``prob`` by its calibrated value; keys without a fit keep theirs, clipped."""
    keys = list(keys)
    names = [f"_of_{k}" for k in keys]
    fitted = _renamed(fitted.select(*keys, F.col("a").alias("_a"), F.col("b").alias("_b")), keys)
    a, b = F.coalesce("_a", F.lit(1.0)), F.coalesce("_b", F.lit(0.0))
    joined = preds.join(fitted, _same(keys), "left")
    return joined.withColumn(prob, calibrated(F.col(prob), a, b)).drop("_a", "_b", *names)
