import random

import pytest
from pyspark.sql import functions as F

import models as m
from edgeframe.operators import blocks, book

SCHEMA = (
    "market string, seq long, venue string, yes_bid double, yes_ask double,"
    "ts_ns long, recv_ns long"
)


def frame(spark, rows):
    full = [(*r, r[1] * 1000, r[1] * 1000 + 2_500_000) for r in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(5)


def found(signals):
    return {
        (r.market, r.seq): (r.buy_venue, r.sell_venue, r.buy_price, r.sell_price)
        for r in signals.collect()
    }


def random_quotes(n=600, seed=3):
    rng = random.Random(seed)
    rows = []
    for seq in range(n):
        # Coarse prices, so that ties are common; one market takes most quotes.
        market = "hot" if rng.random() < 0.7 else rng.choice("ab")
        fair = 0.5 + rng.randint(-4, 4) / 100
        rows.append((market, seq, rng.choice("xyzw"), fair - 0.01, fair + 0.01))
    return rows


@pytest.mark.parametrize("size", [1, 25, 4096])
def test_signals_against_replay(spark, size):
    rows = random_quotes()
    signals = book.arb_signals(frame(spark, rows), block=blocks.seq_blocks(size=size))
    assert found(signals) == m.replay(rows)


def test_unusable_quotes_never_enter_the_book(spark):
    rows = random_quotes(200, 4)
    bad = [("hot", 1000 + i, "x", b, a) for i, (b, a) in enumerate(
        [(None, 0.5), (0.5, None), (0.4, 0.0), (-1.0, 0.5), (float("nan"), 0.5)])]
    late = [("hot", 2000, "y", 0.9, 0.95)]
    got = found(book.arb_signals(frame(spark, rows + bad + late)))
    assert got == m.replay([r for r in rows + late])


def test_one_venue_gives_no_signal(spark):
    rows = [("a", i, "x", 0.6, 0.5) for i in range(5)]
    assert book.arb_signals(frame(spark, rows)).count() == 0


def test_crossed_venue_suppresses_other_pairs(spark):
    rows = [("a", 1, "x", 0.7, 0.4), ("a", 2, "y", 0.6, 0.65)]
    assert book.arb_signals(frame(spark, rows)).count() == 0


def test_smallest_name_wins_a_tie(spark):
    rows = [("a", 1, "z", 0.3, 0.4), ("a", 2, "y", 0.3, 0.4), ("a", 3, "q", 0.5, 0.6),
            ("a", 4, "p", 0.5, 0.6)]
    got = found(book.arb_signals(frame(spark, rows)))
    assert got[("a", 4)] == ("y", "p", 0.4, 0.5)


def test_negative_latency_is_truncated_towards_zero(spark):
    rows = [("a", 1, "x", 0.5, 0.51, 10_000, 8_300), ("a", 2, "y", 0.6, 0.61, 10_000, 8_300)]
    signals = book.arb_signals(spark.createDataFrame(rows, SCHEMA))
    assert [r.latency_us for r in signals.collect()] == [-1]


def test_markets_do_not_share_a_book(spark):
    rows = [("a", 1, "x", 0.3, 0.4), ("b", 2, "y", 0.6, 0.7)]
    assert book.arb_signals(frame(spark, rows)).count() == 0


def test_result_does_not_depend_on_partitions(spark):
    rows = random_quotes(300, 8)
    want = m.replay(rows)
    for n in ("1", "13"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        assert found(book.arb_signals(frame(spark, rows))) == want
    spark.conf.set("spark.sql.shuffle.partitions", "8")


@pytest.mark.parametrize("span", [7, 10_000])
def test_asof(spark, span):
    rng = random.Random(2)
    quotes = [("hot" if i % 3 else "b", i, rng.randint(0, 900)) for i in range(200)]
    forecasts = [("hot", t, t / 1000) for t in rng.sample(range(900), 20)]
    q = spark.createDataFrame(quotes, "market string, seq long, ts_ns long")
    f = spark.createDataFrame(forecasts, "market string, ts_ns long, prob double")
    got = {r.seq: r.prob for r in book.asof_forecast(q, f, ["prob"], span=span).collect()}
    assert len(got) == 200
    for market, seq, t in quotes:
        seen = [(x, p) for k, x, p in forecasts if k == market and x <= t]
        assert got[seq] == (max(seen)[1] if seen else None)


def test_three_hundred_venues(spark):
    rng = random.Random(11)
    rows = []
    for seq in range(900):
        fair = 0.5 + rng.randint(-4, 4) / 100
        rows.append(("hot", seq, f"v{rng.randrange(300):03}", fair - 0.01, fair + 0.01))
    for size in (50, 4096):
        got = found(book.arb_signals(frame(spark, rows), block=blocks.seq_blocks(size=size)))
        assert got == m.replay(rows)


def test_listed_venues_and_quotes_without_one(spark):
    rows = random_quotes(200, 5)
    noise = [("hot", 5000 + i, v, 0.9, 0.1) for i, v in enumerate(["other", None])]
    state = book.book_state(frame(spark, rows + noise), ["x", "y"], blocks.seq_blocks(size=20))
    assert state.count() == len(rows) + 2
    two = [r for r in rows if r[2] in "xy"]
    signals = book.arb_signals(frame(spark, two))
    kept = {(r.market, r.seq) for r in signals.collect()}
    assert {(r.market, r.seq) for r in state.collect() if r.venue in ("x", "y")} >= kept


@pytest.mark.parametrize("size", [4, 37])
def test_nanosecond_numbers_and_many_blocks(spark, size):
    rng = random.Random(size)
    base = 1_700_000_000_000_000_000
    rows = [(m_, base + s * 1_000_003 + rng.randint(0, 9), v, b, a) for m_, s, v, b, a in random_quotes(500, size)]
    # A third of the market in one microsecond.
    rows += [("hot", base + 77_000_000 + i, rng.choice("xyzw"), 0.45 + i % 7 / 100, 0.5 + i % 5 / 100) for i in range(250)]
    signals = book.arb_signals(frame(spark, [r[:1] + (r[1] % 10**15,) + r[2:] for r in rows]), rows=size)
    assert found(signals) == m.replay([r[:1] + (r[1] % 10**15,) + r[2:] for r in rows])


def test_silent_venues_are_carried_over_many_blocks(spark):
    rng = random.Random(5)
    rows = [("hot", i, f"v{i:02}", 0.4 + i / 1000, 0.6 - i / 1000) for i in range(40)]
    rows += [("hot", 100 + i, rng.choice(["v01", "v39", "w"]), 0.5 + rng.randint(-30, 30) / 1000, 0.52) for i in range(400)]
    want = m.replay(rows)
    for size in (3, 10, 1000):
        state = book.book_state(frame(spark, rows), rows=size)
        assert found(book.signals_of(book.arb_events(frame(spark, rows), rows=size))) == want
        assert state.agg(F.max("venue_count")).first()[0] == 41


def test_a_market_without_a_name_has_a_book(spark):
    rows = [(None if r[0] == "hot" else r[0], *r[1:]) for r in random_quotes(200, 6)]
    assert found(book.arb_signals(frame(spark, rows), rows=20)) == m.replay(rows)


def test_blocks_are_bounded_in_rows(spark):
    rng = random.Random(9)
    base = 1_700_000_000_000_000_000
    times = [base + rng.randint(0, 10**15) for _ in range(2000)]  # sparse, in nanoseconds
    times += [base + 5 * 10**14 + i for i in range(3000)]  # crowded: one tick
    times += [base + 2**i for i in range(50)] + [None] * 5
    rows = spark.createDataFrame([("a", t) for t in times] + [("b", 1)], "k string, t long")
    placed, wide = blocks.bounded_blocks(rows, ["k"], F.col("t"), 100)
    assert {r.k for r in wide.collect()} == {"a"} and placed.count() == len(times) + 1
    cells = placed.groupBy("k", "_block").agg(F.count("*").alias("n"), F.min("t").alias("lo"), F.max("t").alias("hi"))
    cells = cells.where("k = 'a'").orderBy("_block").collect()
    assert max(c.n for c in cells) <= 200 and len(cells) < 300
    inside = [c for c in cells if c.lo is not None]
    assert all(x.hi < y.lo for x, y in zip(inside, inside[1:])) and cells[0].lo is None
    one, none = blocks.bounded_blocks(rows, ["k"], F.col("t"), 10_000)
    assert none is None and one.select("_block").distinct().count() == 1


def test_least_over_intervals():
    import numpy as np

    from edgeframe.operators.best_price import least_over

    rng = np.random.default_rng(1)
    for size in (1, 2, 7, 64, 101):
        start = rng.integers(0, size, 60)
        stop = np.minimum(size, start + rng.integers(1, size + 1, 60))
        value = rng.integers(0, 1000, 60)
        plain = [min([v for a, b, v in zip(start, stop, value) if a <= i < b], default=None) for i in range(size)]
        got = [None if x == np.iinfo(np.int64).max else int(x) for x in least_over(start, stop, value, size)]
        assert got == plain


def test_asof_in_one_minute(spark):
    rng = random.Random(3)
    quotes = [("hot", i, rng.randint(0, 300)) for i in range(400)]
    forecasts = [("hot", t, t / 1000) for t in rng.sample(range(300), 20)]
    q = spark.createDataFrame(quotes, "market string, seq long, ts_ns long")
    f = spark.createDataFrame(forecasts, "market string, ts_ns long, prob double")
    got = {r.seq: r.prob for r in book.asof_forecast(q, f, ["prob"], rows=16).collect()}
    for _, seq, t in quotes:
        seen = [(x, p) for _, x, p in forecasts if x <= t]
        assert got[seq] == (max(seen)[1] if seen else None)
