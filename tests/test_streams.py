import random

import pytest
from pyspark.sql import functions as F

import models as m
from edgeframe import schemas
from edgeframe.operators import monitor
from edgeframe.sources import quotes
from edgeframe.storage import children
from edgeframe.streaming import monitor as streams
from edgeframe.streaming import tables
from test_book import SCHEMA, random_quotes

VENUES = ["w", "x", "y", "z"]


def batch(spark, rows):
    full = [(*r, r[1] * 1000, r[1] * 1000 + 2_500_000) for r in rows]
    return spark.createDataFrame(full, SCHEMA)


def found(signals):
    return {
        (r.market, r.seq): (r.buy_venue, r.sell_venue, r.buy_price, r.sell_price)
        for r in signals.collect()
    }


@pytest.mark.parametrize("cuts", [[0, 200], [0, 20, 21, 150, 200]])
def test_stream_equals_batch(spark, fresh, cuts):
    rows = random_quotes(200, 11)
    stream = streams.ArbStream(fresh("arb"), VENUES, block_size=16)
    for i, (a, b) in enumerate(zip(cuts, cuts[1:])):
        stream.process(batch(spark, rows[a:b]), i)
    assert found(stream.signals(spark)) == m.replay(rows)


def test_repeated_batch_changes_nothing(spark, fresh):
    rows = random_quotes(120, 12)
    stream = streams.ArbStream(fresh("arb"), VENUES)
    stream.process(batch(spark, rows[:60]), 0)
    for _ in range(2):
        stream.process(batch(spark, rows[60:]), 1)
    assert found(stream.signals(spark)) == m.replay(rows)
    assert stream.late(spark).count() == 0


def test_a_batch_is_read_in_as_many_tasks_as_it_needs(spark, fresh, monkeypatch):
    """The jobs of a small batch do not run a task for every shuffle partition."""
    given, inner = [], streams.arb_events

    def events(quotes, *args, **named):
        given.append(quotes.rdd.getNumPartitions())
        return inner(quotes, *args, **named)

    monkeypatch.setattr(streams, "arb_events", events)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "48")
    try:
        rows = random_quotes(120, 14)
        stream = streams.ArbStream(fresh("arb"), VENUES, block_size=16)
        for i in range(2):
            stream.process(batch(spark, rows[60 * i : 60 * i + 60]), i)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert len(given) == 2 and max(given) < 48
    assert found(stream.signals(spark)) == m.replay(rows)
    # What a batch held is gone with it.
    names = children(spark, spark.conf.get("spark.checkpoint.dir"))
    assert not [n for n in names if n.startswith(("arb-checked", "arb-known"))]


def test_late_quotes_are_counted_and_left_out(spark, fresh):
    stream = streams.ArbStream(fresh("arb"), VENUES)
    stream.process(batch(spark, [("a", 10, "x", 0.3, 0.4), ("a", 11, "y", 0.3, 0.41)]), 0)
    # x is late (5 <= 10); z has a lower number than the others but is not late.
    second = [("a", 5, "x", 0.9, 0.95), ("a", 8, "z", 0.5, 0.6), ("a", 8, "z", 0.5, 0.6)]
    stream.process(batch(spark, second), 1)
    assert found(stream.signals(spark)) == {("a", 8): ("x", "z", 0.4, 0.5)}
    assert sorted(tuple(r) for r in stream.late(spark).collect()) == [("a", "x", 1), ("a", "z", 1)]
    held = {(r.venue, r.seq) for r in stream.book(spark).collect()}
    assert held == {("x", 10), ("y", 11), ("z", 8)}


def test_venues_that_appear_later_take_part(spark, fresh):
    rows = random_quotes(150, 21)
    rows = [r for r in rows[:70] if r[2] != "z"] + rows[70:]
    stream = streams.ArbStream(fresh("arb"))
    stream.process(batch(spark, [r for r in rows if r[1] < 70]), 0)
    stream.process(batch(spark, [r for r in rows if r[1] >= 70]), 1)
    assert found(stream.signals(spark)) == m.replay(rows)


def test_quotes_without_numbers_are_kept_in_order_of_arrival(spark, fresh):
    rows = random_quotes(120, 22)
    plain = batch(spark, rows).withColumn("seq", F.lit(None).cast("long"))
    stream = streams.ArbStream(fresh("arb"))
    for i, part in enumerate((plain.where("recv_ns < 2550000"), plain.where("recv_ns >= 2550000"))):
        stream.process(part, i)
    wanted = {(k, seq * 1000 + 2_500_000): v for (k, seq), v in m.replay(rows).items()}
    assert found(stream.signals(spark)) == wanted
    assert stream.late(spark).count() == 0


def test_numbers_after_times_are_not_late(spark, fresh):
    plain = batch(spark, [("a", 1, "x", 0.3, 0.4), (None, 1, "x", 0.3, 0.4)]).withColumn("seq", F.lit(None).cast("long"))
    stream = streams.ArbStream(fresh("arb"))
    stream.process(plain, 0)
    numbered = [("a", i, "x", 0.5, 0.6) for i in range(1, 11)] + [("a", 11, "y", 0.7, 0.8)]
    stream.process(batch(spark, numbered), 1)
    assert stream.late(spark).count() == 0
    assert found(stream.signals(spark)) == {("a", 11): ("x", "y", 0.6, 0.7)}
    assert {(r.market, r.venue, r.yes_bid) for r in stream.book(spark).collect()} == {
        ("a", "x", 0.5), ("a", "y", 0.7), (None, "x", 0.3)
    }
    # Old numbers and old times are late, also for a market without a name.
    stream.process(batch(spark, [("a", 10, "x", 0.9, 0.95)]), 2)
    stream.process(plain, 3)
    late = {(r.market, r.venue): r.late for r in stream.late(spark).collect()}
    assert late == {("a", "x"): 2, (None, "x"): 1}
    assert {(r.market, r.venue, r.yes_bid) for r in stream.book(spark).collect()} == {
        ("a", "x", 0.5), ("a", "y", 0.7), (None, "x", 0.3)
    }


def test_messages_may_mix_numbers_and_none(spark, fresh):
    def sent(*rows):
        head = '{"venue": "%s", "market": "a", "yes_bid": %s, "yes_ask": %s%s}'
        rows = [("book.x", head % (v, b, a, "" if n is None else f', "seq": {n}'), t) for v, b, a, n, t in rows]
        messages = spark.createDataFrame(rows, "topic string, payload string, recv_ns long")
        return quotes.decode_quotes(messages, arrival=True)

    first = sent(("x", 0.3, 0.4, None, 10**18))
    assert [r.seq for r in first.collect()] == [None]
    assert [r.seq for r in sent(("x", 0.3, 0.4, 7, 5)).collect()] == [7]
    stream = streams.ArbStream(fresh("arb"))
    stream.process(first, 0)
    stream.process(sent(("x", 0.5, 0.6, 1, 10**18 + 1), ("y", 0.7, 0.8, 2, 10**18 + 2)), 1)
    assert stream.late(spark).count() == 0
    assert found(stream.signals(spark)) == {("a", 2): ("x", "y", 0.6, 0.7)}


def test_lost_state_is_an_error(spark, fresh):
    stream = streams.ArbStream(fresh("arb"))
    stream.process(batch(spark, random_quotes(20, 23)), 0)
    with pytest.raises(ValueError, match="missing"):
        streams.ArbStream(fresh("arb")).process(batch(spark, random_quotes(20, 23)), 1)
    with pytest.raises(ValueError, match="missing"):
        stream.process(batch(spark, random_quotes(20, 23)), 2)


def test_json_stream_end_to_end(spark, fresh):
    landing, out, rows = fresh("landing"), fresh("arb"), random_quotes(90, 13)
    stream = streams.ArbStream(out, VENUES)
    for part in (rows[:50], rows[50:]):
        sent = batch(spark, part)
        encoded = quotes.encode(sent, columns=[f.name for f in schemas.QUOTE.fields])
        encoded.select(
            F.concat(F.lit("book."), "venue").alias("topic"), "payload", "recv_ns"
        ).write.mode("append").json(landing)
        messages = quotes.message_stream(spark, landing)
        decoded = quotes.decode_quotes(quotes.subscribe(messages))
        stream.start(decoded, availableNow=True).awaitTermination()
    assert found(stream.signals(spark)) == m.replay(rows)


def test_tick_stream_matches_batch_counts(spark, fresh):
    landing, out, checkpoint = fresh("landing"), fresh("ticks"), fresh("checkpoint")
    second, rng = 1_000_000_000, random.Random(1)
    schema = "market string, seq long, ts_ns long, recv_ns long"
    rows = [
        (rng.choice("ab"), i, i * second // 3 - rng.randint(-9, 9), i * second // 3)
        for i in range(90)
    ]
    for part in (rows[:40], rows[40:]):
        spark.createDataFrame(part, schema).write.mode("append").parquet(landing)
        landed = quotes.message_stream(
            spark, landing, "parquet", spark.createDataFrame(rows, schema).schema
        )
        ticks = streams.tick_stream(landed, "1 second", "2 seconds")
        streams.append_table(ticks, out, checkpoint, availableNow=True).awaitTermination()
    got = {
        (r.market, r.tick_start_ns // second): (r.messages, r.samples)
        for r in spark.read.parquet(out).collect()
    }
    counts = monitor.tick_counts(spark.createDataFrame(rows, schema))
    want = {(r.market, r.tick): (r.messages, r.samples) for r in counts.collect()}
    closed = (rows[-1][3] - 2 * second) // second
    assert got == {k: v for k, v in want.items() if k[1] + 1 <= closed}


def test_tick_table_has_open_ticks_and_late_rows(spark, fresh):
    second, rng = 1_000_000_000, random.Random(2)
    schema = "market string, seq long, ts_ns long, recv_ns long"
    rows = [
        (rng.choice("ab"), i, i * second // 3 - rng.randint(-9, 9), i * second // 3)
        for i in range(90)
    ]
    late = [("a", 90, 0, second // 2), ("c", 91, 0, 2 * second)]
    table = streams.TickTable(fresh("ticks"))
    for i, part in enumerate((rows[:40], rows[40:], late)):
        for _ in range(2):  # a repeated batch changes nothing
            table.process(spark.createDataFrame(part, schema), i)
    found = table.ticks(spark)
    got = {(r.market, r.tick_start_ns // second): (r.messages, r.samples) for r in found.collect()}
    counts = monitor.tick_counts(spark.createDataFrame(rows + late, schema))
    assert got == {(r.market, r.tick): (r.messages, r.samples) for r in counts.collect()}
    assert sum(n for n, _ in got.values()) == len(rows) + len(late)

    signals = spark.createDataFrame([("a", 0), ("z", 5 * second)], "market string, ts_ns long")
    joined = {(r.market, r.tick): r for r in streams.counts_of(found, signals).collect()}
    assert joined["a", 0].signals == 1 and joined["a", 0].messages == got["a", 0][0]
    assert (joined["z", 5].messages, joined["z", 5].samples, joined["z", 5].signals) == (0, 0, 1)


def test_latest_and_capped_tables(spark, fresh):
    def frame(rows):
        return spark.createDataFrame(rows, "k string, seq long, v string")

    latest, capped = fresh("latest"), fresh("capped")
    keep, cap = tables.latest_sink(latest, ["k"], ["seq"]), tables.capped_sink(capped, ["k"], ["seq"], 2)
    batches = [[("a", 1, "p"), ("a", 2, "q"), ("b", 9, "r")], [("a", 1, "old")], [], [("b", 10, "s")]]
    for i, rows in enumerate(batches):
        for _ in range(2):
            keep(frame(rows), i)
            cap(frame(rows), i)
    assert {tuple(r) for r in tables.current(spark, latest).collect()} == {("a", 2, "q"), ("b", 10, "s")}
    kept = sorted((r.k, r.seq) for r in tables.current(spark, capped).collect())
    assert kept == [("a", 1), ("a", 2), ("b", 9), ("b", 10)]


def test_full_runs_cascade():
    assert tables._full([("a", 0)] * 3) == (0, 0)
    assert tables._full([("a", 1)] + [("b", 0)] * 4) == (4, 1)
    assert tables._full([("a", 2), ("b", 1), ("c", 1), ("d", 1)] + [("e", 0)] * 4) == (7, 2)
    assert tables._full([("a", 1)] * 3 + [("b", 0)] * 3) == (0, 0)


def test_a_batch_writes_its_own_buckets_only(spark, fresh):
    path = fresh("table")
    rule = tables.Rule(["k"], ["seq"], total=["n"], low=["first"])
    table = tables.KeyedTable(path, rule, buckets=8)

    def frame(rows):
        return spark.createDataFrame([(k, s, 1, s) for k, s in rows], "k string, seq long, n long, first long")

    table.update(frame([(c, 0) for c in "abcdefghijkl"]), 0)
    one = table.touched(frame([("a", 1)]))
    assert len(one) == 1
    for i in range(1, 10):
        for _ in range(1 + i % 2):
            table.update(frame([("a", i)]), i)
        for run in (f"batch-{i}", f"merged-{i}"):
            assert set(table._written(spark, run)) <= set(one)
    rows = {r.k: (r.seq, r.n, r["first"]) for r in tables.current(spark, path).collect()}
    assert rows == {"a": (9, 10, 0), **{c: (0, 1, 0) for c in "bcdefghijkl"}}
    # Other buckets still are what the first batch wrote, and what is merged is removed.
    runs = tables._manifest(spark, path, 9)[1]
    assert all(r == [("batch-0", 0)] for b, r in runs.items() if b not in one)
    assert [level for _, level in runs[one[0]]] == [1, 1, 0, 0]
    assert set(children(spark, f"{path}/manifest")) == {"8", "9"}
    assert set(children(spark, f"{path}/rows")) == {"batch-0", "merged-3", "merged-7", "batch-8", "batch-9"}
    with pytest.raises(ValueError, match="other buckets"):
        tables.KeyedTable(path, rule, buckets=4).update(frame([("a", 10)]), 10)


def test_an_empty_table_can_be_read(spark, fresh):
    path = fresh("table")
    keep = tables.latest_sink(path, ["k"], ["seq"])
    keep(spark.createDataFrame([], "k string, seq long"), 0)
    assert tables.current(spark, path).count() == 0
    keep(spark.createDataFrame([(None, 1), (None, 2)], "k string, seq long"), 1)
    assert [tuple(r) for r in tables.current(spark, path).collect()] == [(None, 2)]


def test_feed_keeps_the_newest_signals(spark, fresh):
    rows = random_quotes(300, 31)
    stream = streams.ArbStream(fresh("arb"), VENUES, feed=7)
    for i, at in enumerate(range(0, 300, 60)):
        stream.process(batch(spark, rows[at : at + 60]), i)
        if i == 2:
            stream.process(batch(spark, rows[at : at + 60]), i)  # repeated: changes nothing
    newest = {}
    for r in sorted(stream.signals(spark).collect(), key=lambda r: (r.ts_ns, r.seq)):
        newest.setdefault(r.market, []).append(r.seq)
    feed = {}
    for r in stream.feed(spark).collect():
        feed.setdefault(r.market, []).append(r.seq)
    assert {k: sorted(v) for k, v in feed.items()} == {k: v[-7:] for k, v in newest.items()}
    assert len(feed["hot"]) == 7


def test_live_records_equal_those_of_a_batch(spark, fresh):
    rows = random_quotes(240, 32)
    second = 10**9
    arb, ticks = streams.ArbStream(fresh("arb"), VENUES), streams.TickTable(fresh("ticks"))
    for i, at in enumerate(range(0, 240, 80)):
        part = batch(spark, rows[at : at + 80]).withColumn("recv_ns", F.expr(f"seq * {second} div 5") + F.col("seq") % 7 * 1000)
        part = part.withColumn("ts_ns", F.expr(f"seq * {second} div 5"))
        arb.process(part, i)
        ticks.process(part, i)
    whole = batch(spark, rows).withColumn("recv_ns", F.expr(f"seq * {second} div 5") + F.col("seq") % 7 * 1000)
    whole = whole.withColumn("ts_ns", F.expr(f"seq * {second} div 5"))
    want = monitor.engine_stats(whole, VENUES, samples=16).collect()
    got = ticks.engine_stats(spark, arb.signals(spark), samples=16)
    assert set(got.columns) == set(want[0].asDict())
    assert {tuple(sorted(r.asDict().items())) for r in got.collect()} == {tuple(sorted(r.asDict().items())) for r in want}
    assert max(r.latency_us_p99 for r in want) > 0
