import random

import pytest
from pyspark.sql import functions as F

import models as m
from edgeframe.operators import blocks, monitor, serving

SCHEMA = "market string, seq long, ts_ns long, recv_ns long"
SECOND = 1_000_000_000


def frame(spark, latencies, market="a", gap=SECOND // 4):
    rows = []
    for i, us in enumerate(latencies):
        recv = 10 * SECOND + i * gap
        rows.append((market, i, recv - int(us * 1000), recv))
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.mark.parametrize("n", [1, 2, 3, 101, 8193])
def test_percentiles(spark, n):
    rng = random.Random(n)
    us = [rng.randint(0, 4000) / 2 for _ in range(n)] + [-5.0]
    got = monitor.latency_percentiles(frame(spark, us), (50, 99, 100)).first()
    for p in (50, 99, 100):
        assert got[f"latency_us_p{p}"] == m.lower_rank(us[:-1], p)


def test_percentiles_with_one_value_holding_most_rows(spark):
    us = [7.0] * 3000 + [1.0, 2.0, 5000.5]
    got = monitor.latency_percentiles(frame(spark, us)).first()
    assert (got.latency_us_p50, got.latency_us_p99) == (7.0, 7.0)


def test_no_sample_gives_no_row(spark):
    assert monitor.latency_percentiles(frame(spark, [-1.0, -2.0])).count() == 0


@pytest.mark.parametrize("ring", [1, 5, 64, 8192])
def test_ring(spark, ring):
    rng = random.Random(ring)
    us = [float(rng.randint(-20, 500)) for _ in range(300)]
    got = monitor.rolling_latency(frame(spark, us), samples=ring).collect()
    assert len(got) > 50
    for row in got:
        seen = [x for i, x in enumerate(us) if (10 + i // 4) <= row.tick and x >= 0]
        assert row.sample_count == len(seen)
        assert row.latency_us_p50 == m.lower_rank(seen[-ring:], 50)
        assert row.latency_us_p99 == m.lower_rank(seen[-ring:], 99)


def test_ring_with_all_samples_in_one_tick(spark, monkeypatch):
    monkeypatch.setattr(monitor, "bounded_blocks", lambda df, keys, order: blocks.bounded_blocks(df, keys, order, 20))
    us = [float(i * 37 % 501) for i in range(400)]
    row = monitor.rolling_latency(frame(spark, us, gap=1), samples=64).collect()
    assert len(row) == 1 and row[0].sample_count == 400
    assert row[0].latency_us_p50 == m.lower_rank(us[-64:], 50)


def messages(spark, ticks):
    rows = [("a", i, t * SECOND, t * SECOND) for i, t in enumerate(ticks)]
    return spark.createDataFrame(rows, SCHEMA)


def test_silent_ticks_and_availability(spark):
    counts = monitor.tick_counts(messages(spark, [5, 5, 6, 8, 12]))
    got = {r.tick: r for r in monitor.running_stats(counts, until=13).collect()}
    assert sorted(got) == list(range(5, 14))
    assert [got[t].messages for t in range(5, 14)] == [2, 1, 0, 1, 0, 0, 0, 1, 0]
    assert [got[t].messages_processed for t in (5, 7, 13)] == [2, 3, 5]
    assert got[6].uptime_pct == 100.0
    assert got[7].uptime_pct == pytest.approx(200 / 3)
    assert got[13].uptime_pct == pytest.approx(400 / 9)
    assert got[5].msgs_per_sec == 2.0


def test_long_silence_crosses_blocks(spark):
    far = 3 * monitor.TICKS_PER_BLOCK
    counts = monitor.tick_counts(messages(spark, [1, far]))
    stats = monitor.running_stats(counts)
    assert stats.count() == far
    assert stats.agg(F.max("messages_processed")).first()[0] == 2


def test_engine_stats(spark):
    schema = SCHEMA + ", venue string, yes_bid double, yes_ask double"
    rows = [
        ("a", 1, SECOND, SECOND + 5000, "x", 0.5, 0.51),
        ("a", 2, SECOND, SECOND + 7000, "y", 0.6, 0.61),
        ("a", 3, 4 * SECOND + 9000, 4 * SECOND, "y", 0.6, 0.61),
    ]
    got = {r.tick: r for r in monitor.engine_stats(spark.createDataFrame(rows, schema)).collect()}
    assert sorted(got) == [1, 2, 3, 4]
    assert [got[t].arb_opportunities for t in (1, 3, 4)] == [1, 1, 2]
    assert all(r.trades_executed == r.arb_opportunities for r in got.values())
    assert all((r.latency_us_p50, r.latency_us_p99) == (5.0, 5.0) for r in got.values())
    assert got[4].uptime_pct == 50.0
    newest = serving.health_view(spark.createDataFrame(list(got.values()))).collect()
    assert [r.tick for r in newest] == [4]


def test_approximate_mode_is_close(spark):
    us = [float(i) for i in range(5000)]
    got = monitor.latency_percentiles_approx(frame(spark, us)).first()
    assert abs(got.latency_us_p50 - 2499) <= 2 and abs(got.latency_us_p99 - 4949) <= 2
