"""The backfill against one pass over all observations."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from edgeframe import jobs, schemas
from edgeframe.plans import backfill as b
from edgeframe.sources import weather

DAY = dt.date(2018, 3, 1)
SPANS = "station string, start date, end date"


def day(i):
    return DAY + dt.timedelta(days=i)


@pytest.fixture(scope="module")
def observations(spark):
    rng = random.Random(5)
    rows = [
        (s, f"{day(i)}T00:00:00", kind, rng.randint(0, 90) / 1.0)
        for s, n in (("s1", 900), ("s2", 300), ("other", 50))
        for i in range(n)
        for kind in ("TMAX", "TMIN", "PRCP")
    ]
    return spark.createDataFrame(rows, schemas.OBSERVATION).cache()


@pytest.fixture(scope="module")
def spans(spark):
    rows = [
        ("s1", day(0), day(500)), ("s1", day(400), day(880)), ("s2", day(10), day(250)),
        ("none", day(0), day(20)), (None, day(0), day(9)), ("s2", None, day(9)),
        ("back", day(9), day(0)),
    ]
    return spark.createDataFrame(rows, SPANS)


def rows_of(df):
    return sorted((r.station, r.date, r.tmax_f, r.tmin_f) for r in df.collect())


def wanted(observations, s1=880):
    ends = {"s1": (day(0), day(s1)), "s2": (day(10), day(250))}
    return [
        r for r in rows_of(weather.observations_wide(observations))
        if r[0] in ends and ends[r[0]][0] <= r[1] <= ends[r[0]][1]
    ]


def test_equals_one_pass_and_is_done_once(spark, fresh, observations, spans):
    path = fresh("backfill")
    assert b.read_backfill(spark, path).count() == 0
    assert b.backfill(spark, observations, spans, path, days=100, wave_chunks=5) == 3
    assert rows_of(b.read_backfill(spark, path)) == wanted(observations)
    done = {(r.station, r.chunk_start): r.rows for r in b.committed(spark, path).collect()}
    assert len(done) == 9 + 3 + 1 and done[("none", day(0))] == 0
    assert b.backfill(spark, observations, spans, path, days=100) == 0


def test_stopped_job_is_resumed_with_the_other_chunks(spark, fresh, observations, spans):
    path = fresh("backfill")
    b.backfill(spark, observations, spans, path, days=100, wave_chunks=4, waves=1)
    first = {tuple(r) for r in b.committed(spark, path).select(*b.CHUNK).collect()}
    assert len(first) == 4
    # A second wave writes its rows and stops before it commits.
    commit = b._log

    def stops(chunks, state, batch, where):
        if state == "committed":
            raise RuntimeError("stopped")
        commit(chunks, state, batch, where)

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(b, "_log", stops)
        with pytest.raises(RuntimeError):
            b.backfill(spark, observations, spans, path, days=100, wave_chunks=4)
    assert {tuple(r) for r in b.committed(spark, path).select(*b.CHUNK).collect()} == first

    # Its claim holds others off for a while; later its chunks are taken again.
    plan = b.planned(spans, 100)
    assert b.pending(spark, plan, path).count() == 13 - 4 - 4
    read = observations.where(F.col("date") >= str(day(0)))
    b.backfill(spark, read, spans, path, days=100, claim_seconds=0.0)
    log = b.manifest(spark, path).where("state = 'committed'")
    batches = {r.batch for r in log.collect()}
    assert len(batches) == 2 and log.select(*b.CHUNK).distinct().count() == log.count() == 13
    assert rows_of(b.read_backfill(spark, path)) == wanted(observations)


def test_jobs_that_race_commit_twice_but_count_once(spark, fresh, observations, spans):
    path = fresh("backfill")
    plan = b.planned(spans, 100)
    b.backfill(spark, observations, spans, path, days=100)
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(b, "pending", lambda *args: plan)
        b.backfill(spark, observations, spans, path, days=100, waves=1)
    assert b.manifest(spark, path).where("state = 'committed'").count() == 26
    assert rows_of(b.read_backfill(spark, path)) == wanted(observations)


def test_a_span_grows_at_its_end_only(spark, fresh, observations):
    path = fresh("backfill")

    def span(start, end):
        return spark.createDataFrame([("s1", day(start), day(end))], SPANS)

    b.backfill(spark, observations, span(0, 150), path, days=100)
    b.backfill(spark, observations, span(0, 320), path, days=100)
    log = b.manifest(spark, path).where("state = 'committed'").collect()
    assert sorted((r.chunk_start, r.chunk_end) for r in log) == [
        (day(0), day(99)), (day(100), day(150)), (day(100), day(199)), (day(200), day(299)),
        (day(300), day(320)),
    ]
    got = rows_of(b.read_backfill(spark, path))
    assert got == [r for r in wanted(observations, 320) if r[0] == "s1"]
    with pytest.raises(ValueError, match="not in the plan"):
        b.backfill(spark, observations, span(7, 320), path, days=100)


def test_job_maps_ids_of_the_source(spark, fresh):
    landed, spans, path = fresh("obs"), fresh("spans"), fresh("backfill")
    rows = [
        (station, f"{day(i)}T00:00:00", "TMAX", float(i))
        for station in ("GHCND:USW00094728", "unknown")
        for i in range(30)
    ]
    spark.createDataFrame(rows, schemas.OBSERVATION).write.json(landed)
    spark.createDataFrame([("KNYC", day(3), day(12))], SPANS).write.parquet(spans)
    command = ["backfill", "--observations", landed, "--spans", spans, "--out", path]
    assert jobs.main([*command, "--source-ids"]) == 1
    got = b.read_backfill(spark, path).collect()
    assert sorted((r.station, r.date) for r in got) == [("KNYC", day(i)) for i in range(3, 13)]
