import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from edgeframe import schemas
from edgeframe.operators import features, serving
from edgeframe.plans.ingest import ingest
from edgeframe.sources import lake, listings, quotes, weather

DAY = dt.date(2019, 1, 1)


def daily(spark, n=120, stations=("s1", "s2"), base=50.0):
    rows = [
        (s, DAY + dt.timedelta(days=i), base + (i * 7 + k) % 23, base - 10.0, 60.0, 5.0)
        for k, s in enumerate(stations)
        for i in range(n)
    ]
    return spark.createDataFrame(rows, schemas.RAW_WEATHER)


def test_observations_wide(spark):
    rows = [
        ("s", "2020-01-01T00:00:00", "TMAX", 50.0),
        ("s", "2020-01-01T12:00:00", "TMAX", 52.0),
        ("s", "2020-01-01T00:00:00", "TMIN", 40.0),
        ("s", "2020-01-02T00:00:00", "TMAX", 51.0),
        ("s", "2020-01-03T00:00:00", "TMIN", 39.0),
        ("s", "2020-01-03T00:00:00", "PRCP", 1.0),
    ]
    wide = weather.observations_wide(spark.createDataFrame(rows, schemas.OBSERVATION))
    got = [tuple(r) for r in wide.orderBy("date").collect()]
    assert got == [
        ("s", dt.date(2020, 1, 1), 51.0, 40.0, 60.0, 8.0),
        ("s", dt.date(2020, 1, 2), 51.0, None, 60.0, 8.0),
    ]


def test_observation_files_of_several_chunks(spark, fresh):
    paths = []
    for year in (2019, 2020):
        path = fresh("chunk")
        rows = [("s", f"{year}-01-01T00:00:00", "TMAX", 1.0)]
        spark.createDataFrame(rows, schemas.OBSERVATION).write.json(path)
        paths.append(path)
    assert weather.read_observations(spark, paths).count() == 2


@pytest.mark.parametrize("fmt", ["parquet", "csv", "json", "orc"])
def test_daily_scan_formats(spark, fresh, fmt):
    path, rows = fresh(fmt), daily(spark, 5)
    rows.write.format(fmt).option("header", "true").save(path)
    back = weather.read_daily(spark, path, fmt)
    assert back.schema.simpleString() == schemas.RAW_WEATHER.simpleString()
    assert sorted(back.collect()) == sorted(rows.collect())


def test_chunks_with_missing_columns(spark):
    a, b = spark.createDataFrame([(1, 2)], "x int, y int"), spark.createDataFrame([(3,)], "x int")
    got = sorted(tuple(r) for r in weather.append_chunks([a, b]).collect())
    assert got == [(1, 2), (3, None)]


def test_source_gate_is_per_station(spark):
    primary = daily(spark, 6, ("s1",)).unionByName(daily(spark, 3, ("s2",)))
    got = weather.choose_source(primary, daily(spark, 4, ("s1", "s2", "s3")), min_rows=5)
    counts = {(r.station, r.source): r["count"] for r in got.groupBy("station", "source").count().collect()}
    assert counts == {("s1", "primary"): 6, ("s2", "fallback"): 4, ("s3", "fallback"): 4}


def test_station_ids(spark):
    df = spark.createDataFrame([("KNYC",), ("XXXX",)], "station string")
    got = dict(weather.with_station_id(df, weather.station_ids(spark)).collect())
    assert got == {"KNYC": "GHCND:USW00094728", "XXXX": None}


@pytest.mark.parametrize("days", [0, 365, 366, 367, 731, 732])
def test_backfill_chunks_cover_every_day_once(spark, days):
    span = [(DAY, DAY + dt.timedelta(days=days))]
    spans = spark.createDataFrame(span, "start date, end date")
    chunks = sorted((r.chunk_start, r.chunk_end) for r in weather.backfill_chunks(spans).collect())
    seen = [a + dt.timedelta(days=i) for a, b in chunks for i in range((b - a).days + 1)]
    assert seen == [DAY + dt.timedelta(days=i) for i in range(days + 1)]
    assert all((b - a).days < 366 for a, b in chunks)


def listing(*markets):
    return json.dumps({"markets": [dict(zip(("title", "ticker", "status"), x)) for x in markets]})


def test_listing_filter(spark):
    rows = [
        ("some", listing(("High in NYC", "A", "open"), ("Election", "B", "open"))),
        ("ticker", listing(("x", "KXRAIN", "open"), ("RAIN", "y", "closed"))),
        ("none", listing(("Election", "B", "open"), ("Cup", None, "open"))),
        ("late", listing(*[("Cup", str(i), "open") for i in range(20)], ("snow", "z", "open"))),
        ("bad", "{"),
    ]
    docs = spark.createDataFrame(rows, "listing string, body string")
    kept = listings.weather_listings(listings.parse_listings(docs)).collect()
    by = {}
    for r in kept:
        by.setdefault(r.listing, []).append(r.title)
    assert by["some"] == ["High in NYC"] and by["ticker"] == ["x"]
    assert len(by["none"]) == 2 and len(by["late"]) == 20 and "bad" not in by


def message(**fields):
    return json.dumps(fields)


def test_decode_and_quarantine(spark):
    good = dict(venue="v", market="m", yes_bid=0.4, yes_ask=0.5, seq=7, ts_ns=11)
    payloads = {
        "good": message(**good),
        "bare": message(yes_bid=0.4, yes_ask=0.5),
        "broken": message(**good)[:25],
        "text price": message(**{**good, "yes_ask": "abc"}),
        "zero ask": message(**{**good, "yes_ask": 0.0}),
        "no bid": message(**{k: v for k, v in good.items() if k != "yes_bid"}),
        "list": "[1]",
        "empty": "",
    }
    rows = [("book.v", p, 99) for p in payloads.values()] + [("stat.v", message(**good), 99)]
    sent = quotes.subscribe(spark.createDataFrame(rows, schemas.MESSAGE))
    decoded = {(r.venue, r.market, r.seq, r.ts_ns) for r in quotes.decode_quotes(sent).collect()}
    assert decoded == {("v", "m", 7, 11), ("", "", 0, 99)}
    reasons = sorted(r.reason for r in quotes.quarantine(sent).collect())
    assert reasons == ["malformed"] * 4 + ["unusable price"] * 2
    assert quotes.quarantine(sent).first().topic_venue == "v"


def test_lake_roundtrip_and_pruning(spark, fresh):
    path = fresh("lake")
    built = features.build_features(daily(spark, 500))
    summary = lake.write_lake(built, path)
    assert summary["rows"] == built.count() == lake.read_lake(spark, path).count()
    part = lake.read_lake(spark, path, years=(2020, 2020), columns=["station", "year"])
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan
    assert "ReadSchema: struct<station:string>" in plan
    assert part.count() == built.where("year = 2020").count()


def test_lake_replaces_single_years(spark, fresh):
    path = fresh("lake")
    built = features.build_features(daily(spark, 500))
    lake.write_lake(built, path)
    lake.write_lake(built.where("year = 2020").limit(3), path, replace="years")
    left = {r.year: r["count"] for r in lake.read_lake(spark, path).groupBy("year").count().collect()}
    assert left[2020] == 3 and left[2019] == built.where("year = 2019").count()


def test_ensure_lake_builds_only_when_needed(spark, fresh):
    path, calls = fresh("lake"), []

    def build():
        calls.append(1)
        return features.build_features(daily(spark, 200))

    assert not lake.lake_ready(spark, path)
    first = lake.ensure_lake(spark, path, build).count()
    assert lake.ensure_lake(spark, path, build).count() == first and len(calls) == 1


def test_status_log(spark, fresh):
    path = fresh("status")
    assert lake.log_status(spark, path, "one") and lake.log_status(spark, path, "two", "x")
    assert lake.latest_status(spark, path).first()[:2] == ("two", "x")
    assert lake.log_status(spark, "/proc/nowhere/status", "lost") is False


def test_ingest(spark, fresh):
    path = fresh("lake")
    summary = ingest(spark, daily(spark, 500, ("s1",)), daily(spark, 100), path)
    assert lake.read_lake(spark, path).count() == summary["rows"] == 500 - 3 + 100 - 3
    assert lake.latest_status(spark, f"{path}-status").first().stage == "ingest_done"


def test_contract_columns_are_kept(spark):
    given = daily(spark, 50).withColumns(
        {"label_high": F.lit(1), "market_yes_price": F.lit(0.3), "threshold_f": F.lit(1.0)}
    )
    rows = features.build_features(given).select("label_high", "market_yes_price").distinct()
    assert [tuple(r) for r in rows.collect()] == [(1, 0.3)]


@pytest.mark.parametrize("n,partial,full", [(3, 0, 0), (4, 1, 0), (31, 28, 1), (45, 42, 15)])
def test_warmup(spark, n, partial, full):
    rows = daily(spark, n, ("s",))
    assert features.build_features(rows, "partial").count() == partial
    assert features.build_features(rows, "full").count() == full


def test_missing_highs(spark):
    rows = daily(spark, 60, ("s",))
    holes = rows.withColumn("tmax_f", F.when(F.dayofmonth("date") != 9, F.col("tmax_f")))
    built = features.build_features(holes)
    # The three rows after each hole lack a lag.
    assert built.count() == 60 - 3 - 2 * 3


def test_features_ignore_the_future_and_other_stations(spark):
    rows = daily(spark, 80)
    cutoff = F.lit(DAY + dt.timedelta(days=50))
    changed = rows.withColumn(
        "tmax_f", F.when(F.col("date") > cutoff, F.lit(0.0)).otherwise(F.col("tmax_f"))
    )
    alone = rows.where("station = 's1'")
    want = sorted(features.build_features(rows).where(F.col("date") <= cutoff).collect())
    assert sorted(features.build_features(changed).where(F.col("date") <= cutoff).collect()) == want
    only = sorted(features.build_features(alone).where(F.col("date") <= cutoff).collect())
    assert only == [r for r in want if r.station == "s1"]


def test_point_read_defaults(spark):
    store = spark.createDataFrame(
        [("a", '{"stage":"x","detail":"d","ts":1.0}'), ("b", "{oops")], "key string, payload string"
    )
    wanted = spark.createDataFrame([("a",), ("b",), ("c",)], "key string")
    got = serving.point_read(wanted, store, schemas.STATUS, {"stage": "?"}).collect()
    assert {r.key: r.stage for r in got} == {"a": "x", "b": "?", "c": "?"}


def test_views(spark):
    signal = spark.createDataFrame(
        [("m", i, "x", 0.00123456, 9) for i in range(60)],
        "market string, ts_ns long, buy_venue string, spread_pct double, latency_us long",
    )
    view = serving.signal_view(signal)
    assert view.columns == ["market", "buy_venue", "spread_%", "latency_us"]
    assert view.count() == 25 and view.first()["spread_%"] == 0.123
    latest = spark.createDataFrame([("x", 1), ("y", 2)], "venue string, seq int")
    listed = spark.createDataFrame([("x",), ("q",)], "venue string")
    assert [r.venue for r in serving.venue_quotes(latest, listed).collect()] == ["x"]
    curve = spark.createDataFrame([("m", "2020-01-02", 2.0), ("m", "2020-01-01", 1.0)],
                                  "market string, date string, equity double")
    assert [r.equity for r in serving.equity_view(curve).collect()] == [1.0, 2.0]
