"""Blocked computations equal the plain windows, whatever the blocks."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from edgeframe.operators import blocks


@pytest.fixture(scope="module")
def events(spark):
    rng = random.Random(5)
    rows = []
    # "hot" holds most rows; seq has gaps, so blocks have very different sizes.
    for key, n in (("hot", 400), ("b", 30), ("c", 1)):
        for seq in sorted(rng.sample(range(5000), n)):
            x = float(rng.randint(-5, 9)) if rng.random() < 0.6 else None
            rows.append((key, seq, x))
    return spark.createDataFrame(rows, "key string, seq long, x double").repartition(5).cache()


SIZES = [3, 50, 100000]


def plain():
    return Window.partitionBy("key").orderBy("seq")


def running():
    return plain().rowsBetween(Window.unboundedPreceding, 0)


def same(left, right):
    columns = sorted(right.columns)
    a, b = (sorted(map(tuple, d.select(*columns).collect()), key=str) for d in (left, right))
    assert a == b


def blocked(events, size):
    return events.withColumn(blocks.BLOCK, blocks.seq_blocks(size=size))


@pytest.mark.parametrize("size", SIZES)
def test_prefix_sums(events, size):
    got = blocks.prefix_sums(
        blocked(events, size), ["key"], ["seq"], {"s": F.col("x"), "n": F.lit(1)}
    )
    want = events.withColumns(
        {"s": F.coalesce(F.sum("x").over(running()), F.lit(0.0)), "n": F.count("*").over(running())}
    )
    same(got.drop(blocks.BLOCK), want)


@pytest.mark.parametrize("size", SIZES)
def test_carried(events, size):
    rows = blocked(events, size)
    row = F.when(F.col("x").isNotNull(), F.struct("seq", "x"))
    ends = rows.groupBy("key", blocks.BLOCK).agg(F.max(row).alias("slot"))
    frame = blocks.seeds_first(["key"], ["seq"])
    got = (
        blocks.with_carried(rows, ["key"], ends, ["slot"])
        .withColumn("l", F.last("x", True).over(frame))
        .where(~F.col("_seed"))
        .drop("_seed", blocks.BLOCK)
    )
    same(got, events.withColumn("l", F.last("x", True).over(running())))


@pytest.mark.parametrize("size", SIZES)
def test_positions(events, size):
    got = blocks.positions(blocked(events, size), ["key"], ["seq"])
    want = events.withColumns(
        {
            "_pos": (F.row_number().over(plain()) - 1).cast("long"),
            "_total": F.count("*").over(Window.partitionBy("key")),
        }
    )
    same(got.drop(blocks.BLOCK), want)


@pytest.mark.parametrize("size", SIZES)
@pytest.mark.parametrize("n", [1, 4, 30])
def test_history(events, size, n):
    rows = blocks.with_history(blocked(events, size), ["key"], ["seq"], n)
    w = blocks.in_block(["key"], ["seq"])
    got = (
        rows.withColumns(
            {"lag": F.lag("x", n).over(w), "k": F.count("*").over(w.rowsBetween(-n, -1))}
        )
        .where(~F.col("_seed"))
        .drop("_seed", blocks.BLOCK)
    )
    want = events.withColumns(
        {"lag": F.lag("x", n).over(plain()), "k": F.count("*").over(plain().rowsBetween(-n, -1))}
    )
    same(got, want)


@pytest.mark.parametrize("n", [1, 7, 1000])
def test_newest(events, n):
    got = blocks.newest(events, ["key"], ["seq"], n)
    order = Window.partitionBy("key").orderBy(F.col("seq").desc())
    want = events.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= n)
    same(got, want)


def test_rows_are_never_partitioned_by_the_key_alone(events):
    plan = blocks.prefix_sums(blocked(events, 50), ["key"], ["seq"], {"s": F.col("x")})
    text = plan._jdf.queryExecution().executedPlan().toString()
    windows = [line for line in text.splitlines() if " Window [" in line]
    row_windows = [line for line in windows if "seq#" in line]
    assert row_windows and all("_block#" in line.split("windowspecdefinition")[1] for line in row_windows)
