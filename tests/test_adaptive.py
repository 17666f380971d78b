import numpy as np
import pytest
from pyspark.sql import functions as F

from edgeframe.operators import adaptive, search
from test_backtest import member_rows, want_score


def two_peaks(rng):
    """A score with a lower and a higher peak, apart from each other."""
    width, centres = rng.uniform(0.1, 0.2), rng.random((2, 2))
    while ((centres[0] - centres[1]) ** 2).sum() < 0.2:
        centres = rng.random((2, 2))
    heights = (0.8, 1.0)
    return lambda x: sum(
        h * np.exp(-((x - c) ** 2).sum(axis=1) / (2 * width**2)) for h, c in zip(heights, centres)
    )


def searched(score, seed):
    points = adaptive._spread(np.random.default_rng([seed, 0]), adaptive.SPREAD)
    turn = 1
    while len(points) < adaptive.TRIALS:
        rng = np.random.default_rng([seed, turn])
        more = adaptive.propose(points, score(points), adaptive.ROUND, rng)
        points, turn = np.vstack([points, more]), turn + 1
    assert len(points) == adaptive.TRIALS and (0 <= points).all() and (points <= 1).all()
    return score(points).max()


def test_forty_trials_mostly_beat_the_grid():
    grid = np.array(search.grid())
    grid = (grid - adaptive._LOW) / (adaptive._HIGH - adaptive._LOW)
    won = []
    for seed in range(60):
        score = two_peaks(np.random.default_rng([90, seed]))
        won.append(searched(score, seed) > score(grid).max())
    assert len(grid) == 108 and np.mean(won) > 0.6


def test_proposals_gather_where_scores_are_high():
    points = np.random.default_rng(1).random((30, 2))
    best = np.array([0.3, 0.7])
    found = adaptive.propose(
        points, -((points - best) ** 2).sum(axis=1), 6, np.random.default_rng(2)
    )
    assert np.abs(found - best).mean() < np.abs(points - best).mean() / 2
    assert len({tuple(p) for p in found}) == 6


def test_equal_and_missing_scores_do_not_stop_it():
    points = np.random.default_rng(1).random((5, 2))
    for scores in (np.zeros(5), np.full(5, -np.inf)):
        assert adaptive.propose(points, scores, 3, np.random.default_rng(2)).shape == (3, 2)


def test_search_over_markets(spark):
    rows, df = member_rows(spark, 90)
    nameless = df.where("market = 'b'").withColumn("market", F.lit(None).cast("string"))
    df = df.unionByName(nameless).cache()
    scored = []

    def score(tried):
        out = search.score_candidates(df, tried)
        scored.append(out)
        return out

    done = adaptive.trials_of(df, score, trials=22)
    trials = done.collect()
    names = {r.market for r in trials}
    assert None in names and len(scored) == 2
    for name in names:
        of = [r for r in trials if r.market == name]
        assert len({(r.weight, r.threshold) for r in of}) == len(of) == 22
        assert any(r.weight == 0.5 and abs(r.threshold - 0.02) < 1e-12 for r in of)
    for r in [r for r in trials if r.market is not None][::7]:
        assert r.score == pytest.approx(want_score(rows, r.market, r.weight, r.threshold)[1], abs=1e-9)
    best = {r.market: r for r in adaptive.adaptive_search(df.repartition(7), trials=22).collect()}
    for name in names:
        top = max(r.score for r in trials if r.market == name)
        assert best[name].score == top and best[name].opt_method == adaptive.METHOD


def test_no_markets_and_too_few_trials(spark):
    _, df = member_rows(spark, 10)
    assert adaptive.adaptive_search(df.limit(0), trials=16).count() == 0
    with pytest.raises(ValueError, match="three trials"):
        adaptive.adaptive_search(df, trials=2)
