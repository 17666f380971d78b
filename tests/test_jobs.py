"""The submit commands, run one after the other on small inputs."""

import datetime as dt
import json
import random

from edgeframe import jobs, schemas
from edgeframe.operators import serving
from edgeframe.sources import lake
from test_book import random_quotes

DAY = dt.date(2020, 1, 1)


def observations(n=430):
    rng = random.Random(2)
    for i in range(n):
        day = f"{DAY + dt.timedelta(days=i)}T00:00:00"
        high = 50 + rng.randint(0, 80) / 4
        yield ("s1", day, "TMAX", high)
        yield ("s1", day, "TMIN", high - 10)


def test_ingest_then_study(spark, fresh):
    landed, fallback, path, out = fresh("obs"), fresh("daily"), fresh("lake"), fresh("study")
    spark.createDataFrame(list(observations()), schemas.OBSERVATION).write.json(landed)
    rows = [("s2", DAY + dt.timedelta(days=i), 40.0 + i * 7 % 23, 30.0, 60.0, 8.0) for i in range(90)]
    spark.createDataFrame(rows, schemas.RAW_WEATHER).write.parquet(fallback)
    summary = jobs.main(
        ["ingest", "--primary", landed, "--fallback", fallback, "--lake", path]
    )
    assert summary["rows"] == 430 - 3 + 90 - 3 == lake.read_lake(spark, path).count()

    metrics = jobs.main(["study", "--lake", path, "--out", out])
    assert {r.market for r in metrics.collect()} == {"s1", "s2"}
    sizes = spark.read.parquet(f"{out}/live/sizing")
    assert serving.latest_by_key(sizes, ["market"], ["ts_ns"]).count() == 2


def test_monitor_then_stats(spark, fresh):
    landing, out = fresh("landing"), fresh("monitor")
    venues = ["w", "x", "y", "z"]
    rows = []
    for market, seq, venue, bid, ask in random_quotes(150, 21):
        body = dict(venue=venue, market=market, yes_bid=bid, yes_ask=ask, seq=seq, ts_ns=seq * 10**8)
        rows.append((f"book.{venue}", json.dumps(body), seq * 10**8 + 5000))
    spark.createDataFrame(rows, schemas.MESSAGE).write.json(landing)
    common = ["--out", out, "--venues", *venues]
    jobs.main(["monitor", "--landing", landing, "--once", *common])
    stats = jobs.main(["stats", *common])
    last = {r.market: r for r in serving.latest_by_key(stats, ["market"], ["tick"]).collect()}
    # Ticks are final once the watermark has passed them, ten seconds behind the last quote.
    closed = [r for r in random_quotes(150, 21) if r[1] < 40 and r[0] == "hot"]
    assert last["hot"].messages_processed == len(closed)
    assert 0 < last["hot"].arb_opportunities <= len(closed)
    assert spark.read.parquet(f"{out}/feed").groupBy("market").count().count() > 0


def test_stats_all_has_every_quote_and_signal(spark, fresh):
    landing, out = fresh("landing"), fresh("monitor")
    rows = []
    for market, seq, venue, bid, ask in random_quotes(150, 21):
        body = dict(venue=venue, market=market, yes_bid=bid, yes_ask=ask, seq=seq, ts_ns=seq * 10**8)
        rows.append((f"book.{venue}", json.dumps(body), seq * 10**8 + 5000))
    spark.createDataFrame(rows, schemas.MESSAGE).write.json(landing)
    jobs.main(["monitor", "--landing", landing, "--once", "--out", out])
    jobs.main(["stats", "--out", out])
    stats = spark.read.parquet(f"{out}/stats_all")
    last = serving.latest_by_key(stats, ["market"], ["tick"]).collect()
    assert sum(r.messages_processed for r in last) == 150
    signals = spark.read.parquet(f"{out}/arb/signals").count()
    assert sum(r.arb_opportunities for r in last) == signals > 0
