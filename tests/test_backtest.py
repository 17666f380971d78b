import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

import models as m
from edgeframe.operators import backtest, blocks, search

DAY = dt.date(2020, 1, 1)
SCHEMA = "market string, date date, model_prob double, market_prob double, outcome int"


def series(market, n, seed, win=None):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        q = rng.uniform(0.2, 0.8)
        p = min(max(q + rng.uniform(-0.12, 0.12), 0.01), 0.99)
        y = int(rng.random() < q) if win is None else win(p, q)
        rows.append((market, DAY + dt.timedelta(days=i + rng.randint(0, 1) * 0), p, q, y))
    return rows


def check(spark, rows, block=None, **kw):
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    metrics, equity = backtest.run_backtest(df, block=block, **kw)
    got = {r.market: r for r in metrics.collect()}
    curve = {(r.market, r.date): r.equity for r in equity.collect()}
    for market in {r[0] for r in rows}:
        want, line = m.backtest([r[1:] for r in rows if r[0] == market])
        for name, value in want.items():
            expected = value if value is None else pytest.approx(value, abs=1e-9)
            assert getattr(got[market], name) == expected, (market, name)
        for date, value in line:
            assert curve[(market, date)] == pytest.approx(value, abs=1e-9)
        assert got[market].window_start == min(r[1] for r in rows if r[0] == market).isoformat()
    return got


@pytest.mark.parametrize("days", [7, 100, 4096])
def test_against_row_loop(spark, days):
    rows = series("hot", 500, 1) + series("b", 40, 2) + series("one", 1, 3)
    check(spark, rows, blocks.day_blocks(days=days))


def test_all_pass(spark):
    rows = [("a", DAY + dt.timedelta(days=i), 0.5, 0.5, 1) for i in range(5)]
    got = check(spark, rows)["a"]
    assert (got.n_trades, got.sharpe, got.max_drawdown, got.final_bankroll) == (0, 0, 0, 5000)


def test_ruin_has_no_monthly_return(spark):
    rows = series("a", 300, 4, win=lambda p, q: 0 if p > q else 1)
    got = check(spark, rows)["a"]
    assert got.final_bankroll < 0 and got.monthly_roi is None


def test_missing_probabilities_are_not_traded(spark):
    rows = [("a", DAY, None, 0.4, 1), ("a", DAY + dt.timedelta(days=1), float("nan"), 0.4, 1)]
    assert check(spark, rows)["a"].n_trades == 0


def member_rows(spark, n=260):
    rng = random.Random(9)
    rows = []
    for market, k in (("hot", n), ("b", 30), ("tiny", 2)):
        for i in range(k):
            q = rng.uniform(0.3, 0.7)
            rows.append((
                market, DAY + dt.timedelta(days=i), q + rng.uniform(-0.1, 0.1),
                q + rng.uniform(-0.1, 0.1), q, int(rng.random() < q),
            ))
    return rows, spark.createDataFrame(
        rows,
        "market string, date date, lstm_prob double, transformer_prob double,"
        "market_prob double, outcome int",
    )


def want_score(rows, market, w, t):
    mixed = [
        (d, min(max(w * a + (1 - w) * b, 1e-4), 1 - 1e-4), q, y)
        for k, d, a, b, q, y in rows
        if k == market
    ]
    got, _ = m.backtest(mixed, t)
    if got["n_trades"] < 3:
        return got, -1 + 0.001 * got["n_trades"]
    return got, got["total_return"] - 0.5 * got["max_drawdown"]


@pytest.mark.parametrize("days", [20, 5000])
def test_search_scores(spark, days):
    rows, df = member_rows(spark)
    pairs = search.grid(3, 3)
    scores = search.score_candidates(df.repartition(6), pairs, blocks.day_blocks(days=days))
    found = scores.collect()
    assert len(found) == 3 * len(pairs)
    for r in found:
        want, score = want_score(rows, r.market, r.weight, r.threshold)
        assert r.n_trades == want["n_trades"]
        assert r.max_drawdown == pytest.approx(want["max_drawdown"], abs=1e-9)
        assert r.score == pytest.approx(score, abs=1e-9)


def test_grid_covers_the_box_in_order():
    points = search.grid()
    assert len(points) == 108 and points == sorted(points)
    assert points[0] == (0.0, 0.005) and points[-1] == (1.0, 0.04)


def test_ties_go_to_the_first_candidate(spark):
    scores = spark.createDataFrame(
        [("a", 1.0, 0.01, 2.0), ("a", 0.0, 0.03, 2.0), ("a", 0.0, 0.02, 2.0), ("a", 0.5, 0.0, 1.0)],
        "market string, weight double, threshold double, score double",
    )
    best = search.best_candidates(scores).first()
    assert (best.weight_lstm, best.edge_threshold) == (0.0, 0.02)


def test_refinement_never_lowers_the_score(spark):
    _, df = member_rows(spark, 120)
    df = df.cache()
    coarse = {r.market: r.score for r in search.grid_search(df).collect()}
    fine = {r.market: r.score for r in search.refined_search(df).collect()}
    assert set(coarse) == set(fine)
    assert all(fine[k] >= coarse[k] - 1e-12 for k in coarse)


def test_threshold_column(spark):
    rows = series("a", 60, 5)
    df = spark.createDataFrame(rows, SCHEMA).withColumn("t", F.lit(0.05))
    metrics, _ = backtest.run_backtest(df, F.col("t"))
    want, _ = m.backtest([r[1:] for r in rows], 0.05)
    assert metrics.first().n_trades == want["n_trades"]


def test_search_sizes_as_the_backtest_does(spark):
    _, df = member_rows(spark, 120)
    sizes = search.Sizes(safety=0.9, cap=0.4, bankroll=1234.0, fee=0.01)
    scores = search.score_candidates(df, [(0.3, 0.01), (0.8, 0.02)], blocks.day_blocks(days=30), sizes)
    for r in scores.collect():
        mixed = df.where(F.col("market") == r.market).withColumn(
            "model_prob", r.weight * F.col("lstm_prob") + (1 - r.weight) * F.col("transformer_prob")
        )
        want, _ = backtest.run_backtest(mixed, r.threshold, 0.9, 0.4, 1234.0, 0.01)
        want = want.first()
        assert r.n_trades == want.n_trades > 0
        assert r.total_return == pytest.approx(want.total_return, abs=1e-6)
        assert r.max_drawdown == pytest.approx(want.max_drawdown, abs=1e-6)


def test_rows_without_market_or_date_are_traded(spark):
    rows = spark.createDataFrame(
        [("a", "2024-01-01", 0.7, 0.5, 1), (None, "2024-01-01", 0.7, 0.5, 1), ("a", None, 0.7, 0.5, 0)],
        "market string, day string, model_prob double, market_prob double, outcome int",
    ).withColumn("date", F.to_date("day"))
    metrics, curve = backtest.run_backtest(rows)
    assert curve.count() == 3
    assert {r.market: r.n_trades for r in metrics.collect()} == {"a": 2, None: 1}
