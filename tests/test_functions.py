import math
from statistics import NormalDist

import pytest
from pyspark.sql import functions as F

import models as m
from edgeframe.functions import contracts, numeric

NAN = float("nan")


def test_clip_keeps_missing_values_missing(spark):
    df = spark.createDataFrame([(None,), (NAN,), (-1.0,), (0.5,), (2.0,)], "x double")
    got = [r[0] for r in df.select(numeric.probability(F.col("x"))).collect()]
    assert got == [None, None, 1e-4, 0.5, 1 - 1e-4]


@pytest.mark.parametrize("p", [0.0005, 0.01, 0.02425, 0.5, 0.7, 0.97575, 0.99, 0.9995])
def test_inverse_normal(spark, p):
    got = spark.range(1).select(numeric.inverse_normal(F.lit(p))).first()[0]
    assert got == pytest.approx(NormalDist().inv_cdf(p), abs=1e-8)


def test_point_estimate_limits_the_probability(spark):
    got = spark.range(1).select(numeric.point_estimate(F.lit(1.0), F.lit(70.0))).first()[0]
    assert got == pytest.approx(70 + 7 * NormalDist().inv_cdf(0.999), abs=1e-6)


def test_percent(spark):
    df = spark.createDataFrame([(0.1234,), (None,), (NAN,), (-0.05,)], "x double")
    got = [r[0] for r in df.select(numeric.percent(F.col("x"), 1)).collect()]
    assert got == ["12.3%", "-", "-", "-5.0%"]


def test_hashed_noise_depends_on_keys_only(spark):
    df = spark.range(2000).withColumn("k", F.concat(F.lit("s"), F.col("id")))
    column = numeric.hashed_uniform(F.col("k")).alias("u")
    one = sorted(r[0] for r in df.repartition(1).select(column).collect())
    many = sorted(r[0] for r in df.repartition(7).select(column).collect())
    assert one == many
    assert 0 <= one[0] and one[-1] < 1 and abs(sum(one) / 2000 - 0.5) < 0.03
    z = [r[0] for r in df.select(numeric.hashed_normal(F.col("k"))).collect()]
    mean = sum(z) / len(z)
    assert abs(mean) < 0.08
    assert abs(math.sqrt(sum((x - mean) ** 2 for x in z) / len(z)) - 1) < 0.08


CASES = [
    (p, q)
    for p in (None, NAN, 0.0, 0.3, 0.5, 0.52, 0.55, 1.0)
    for q in (None, NAN, 0.0, 0.5, 0.53, 1.0)
]


@pytest.mark.parametrize("threshold", [0.0, 0.02, 0.05])
def test_decision_and_sizing(spark, threshold):
    df = spark.createDataFrame(CASES, "p double, q double")
    decided = df.withColumns(contracts.decide(F.col("p"), F.col("q"), threshold))
    full = contracts.kelly_full(F.col("side"), F.col("p"), F.col("q"))
    for row in decided.withColumn("full", full).collect():
        side, edge = m.decide(row.p, row.q, threshold)
        assert (row.side, row.edge) == (side, pytest.approx(edge)), row
        assert row.full == pytest.approx(m.kelly(side, row.p, row.q)), row


def test_pass_is_never_sized(spark):
    df = spark.createDataFrame([(0.5, 0.5, 1)], "p double, q double, y int")
    side = F.lit("PASS")
    used = contracts.kelly_used(contracts.kelly_full(side, F.col("p"), F.col("q")))
    row = df.select(used, contracts.stake(used), contracts.profit(side, used, F.col("q"), F.col("y")))
    assert list(row.first()) == [0.0, 0.0, 0.0]
