"""The whole study on a small lake: train, search, calibrate, backtest, live forecast."""

import datetime as dt
import math
import random

import pytest

from edgeframe import schemas
from edgeframe.operators import features, serving
from edgeframe.plans import forecast
from edgeframe.sources import lake as lake_io


@pytest.fixture(scope="module")
def lake(spark):
    from edgeframe.storage import scratch

    rng = random.Random(0)
    rows = []
    for station, n in (("a", 320), ("b", 200)):
        warmth = 0.0
        for i in range(n):
            warmth = 0.8 * warmth + rng.gauss(0, 1)
            high = 60 + 15 * math.sin(i / 58) + 6 * warmth
            day = dt.date(2020, 1, 1) + dt.timedelta(days=i)
            rows.append((station, day, round(high, 2), round(high - 15, 2), 60.0, 8.0))
    path = scratch(spark, "lake")
    daily = spark.createDataFrame(rows, schemas.RAW_WEATHER)
    lake_io.write_lake(features.build_features(daily, pricing="naive"), path)
    return lake_io.read_lake(spark, path)


@pytest.fixture(scope="module")
def study(spark, lake):
    return forecast.run_study(spark, lake)


def test_metrics_carry_the_run_metadata(study):
    rows = {r.market: r for r in study.metrics.collect()}
    assert set(rows) == {"a", "b"}
    for r in rows.values():
        assert r.opt_method == "grid-search" and set(r.backends) == {"lstm", "transformer"}
        assert 0 <= r.weight_lstm <= 1 and 0.005 <= r.edge_threshold <= 0.04
        assert r.total_return == pytest.approx(r.final_bankroll / 5000 - 1, abs=1e-5)


def test_equity_covers_the_test_window(study):
    n = (320 - 3 - 14) // 5
    assert study.equity.where("market = 'a'").count() == n


def test_members_beat_a_coin_on_persistent_weather(study):
    for r in study.accuracy.collect():
        assert r.accuracy_lstm > 0.5 and r.accuracy_ensemble > 0.5


def test_live_messages(spark, lake, study, fresh):
    path = fresh("live")
    messages = forecast.publish_live(lake, study.fitted, 123, path)
    sent = [spark.read.parquet(f"{path}/{n}") for n in ("forecast", "odds", "sizing")]
    assert [t.count() for t in sent] == [2, 2, 2]
    for table, schema in zip(messages, (schemas.FORECAST, schemas.ODDS, schemas.SIZING)):
        assert table.columns == schema.fieldNames()
    view = {r.market: r for r in serving.forecast_view(*sent).collect()}
    assert view["a"].target_date == "2020-11-16"
    for r in view.values():
        assert r.ensemble_pct == f"{r.ensemble_prob * 100:.2f}%"
        assert (r.side == "PASS") == (r.stake_usd == 0)
        assert r.stake_usd <= 125.0
