import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from edgeframe.defaults import FEATURES
from edgeframe.operators import blocks, calibrate, dataset, models

DAY = dt.date(2020, 1, 1)


@pytest.fixture(scope="module")
def lake(spark):
    rng = random.Random(1)
    rows = []
    for station, n in (("hot", 150), ("b", 40), ("tiny", 16)):
        for i in range(n):
            day = DAY + dt.timedelta(days=2 * i)
            x = [rng.uniform(0, 9) for _ in FEATURES]
            rows.append((station, day, *x, int(rng.random() < 0.5), 0.5, 7.0))
    schema = "station string, date date, " + ", ".join(f"{f} double" for f in FEATURES)
    schema += ", label_high int, market_yes_price double, threshold_f double"
    return spark.createDataFrame(rows, schema).repartition(4).cache()


def arrays(lake, station):
    rows = sorted(r for r in lake.collect() if r.station == station)
    return rows, np.array([[r[f] for f in FEATURES] for r in rows])


def sizes(n):
    test, val = max(1, int(n * 0.2)), max(1, int(n * 0.15))
    return n - test - val, val, test


@pytest.mark.parametrize("days", [11, 10000])
def test_windows_and_splits(lake, days):
    built = dataset.build_dataset(lake, block=blocks.day_blocks(days=days)).collect()
    assert {r.station for r in built} == {"hot", "b"}
    for station in ("hot", "b"):
        rows, x = arrays(lake, station)
        got = sorted((r for r in built if r.station == station), key=lambda r: r.date)
        assert [r.date for r in got] == [r.date for r in rows[14:]]
        for i, r in enumerate(got):
            assert np.array_equal(np.array(r.window), x[i : i + 14])
            assert (r.label, r.high) == (rows[i + 14].label_high, rows[i + 14].tmax_f)
        train, val, test = sizes(len(got))
        assert [r.split for r in got] == ["train"] * train + ["val"] * val + ["test"] * test


def test_short_stations_are_reported(lake):
    assert [r.station for r in dataset.short_stations(lake).collect()] == ["tiny"]


def train_windows(lake, station):
    _, x = arrays(lake, station)
    n = len(x) - 14
    return np.array([x[i : i + 14] for i in range(n)]), sizes(n)[0]


@pytest.mark.parametrize("days", [11, 10000])
def test_train_statistics(lake, days):
    stats = dataset.train_statistics(lake, block=blocks.day_blocks(days=days)).collect()
    for r in stats:
        if r.station == "tiny":
            continue
        windows, train = train_windows(lake, r.station)
        flat = windows[:train].reshape(-1, len(FEATURES))
        assert np.allclose([r[f"mean_{f}"] for f in FEATURES], flat.mean(0), atol=1e-9)
        assert np.allclose([r[f"std_{f}"] for f in FEATURES], flat.std(0) + 1e-6, atol=1e-9)


def test_statistics_ignore_test_rows(lake):
    cutoff = F.lit(DAY + dt.timedelta(days=2 * 140))
    changed = lake.withColumn(
        "humidity", F.when(F.col("date") >= cutoff, 1e6).otherwise(F.col("humidity"))
    )
    one = dataset.train_statistics(lake).where("station = 'hot'").first()
    assert dataset.train_statistics(changed).where("station = 'hot'").first() == one


def test_summaries(lake):
    stats = dataset.train_statistics(lake)
    got = dataset.window_summaries(lake, stats).where("station = 'hot'").orderBy("date").collect()
    windows, train = train_windows(lake, "hot")
    flat = windows[:train].reshape(-1, len(FEATURES))
    z = (windows - flat.mean(0)) / (flat.std(0) + 1e-6)
    want = np.concatenate([z.mean(axis=1), z[:, -1, :]], axis=1)
    assert np.allclose([[r[n] for n in models.SUMMARY] for r in got], want, atol=1e-9)
    window = dataset.standardize_windows(dataset.build_dataset(lake), stats)
    first = window.where("station = 'hot'").orderBy("date").first()
    assert np.allclose(np.array(first.window), z[0], atol=1e-9)


def test_live_window(lake):
    live = {r.station: r for r in dataset.live_windows(lake).collect()}
    rows, x = arrays(lake, "hot")
    assert np.array_equal(np.array(live["hot"].window), x[-14:])
    assert live["hot"].date == rows[-1].date
    assert live["hot"].last_wind_mph == x[-1][FEATURES.index("wind_mph")]


def descend(x, y, rate, epochs):
    w, b = np.zeros(x.shape[1]), 0.0
    for _ in range(epochs):
        miss = 1 / (1 + np.exp(-(x @ w + b))) - y
        w, b = w - rate * (miss[:, None] * x).mean(0), b - rate * miss.mean()
    return w, b


@pytest.fixture(scope="module")
def train(spark):
    rng = np.random.default_rng(3)
    rows = [
        (s, float(a), float(b), int(rng.random() < 1 / (1 + np.exp(-(a - b / 2)))))
        for s, n in (("hot", 200), ("b", 30))
        for a, b in rng.normal(size=(n, 2))
    ]
    return spark.createDataFrame(rows, "station string, u double, v double, label int").cache()


@pytest.mark.parametrize("local_rows,epochs", [(1000, 300), (100, 4), (1, 4)])
def test_descent_is_the_same_inside_and_across_tasks(train, local_rows, epochs):
    model = models.fit_logistic(train, ["u", "v"], epochs=epochs, local_rows=local_rows)
    got = {r.station: r for r in model.collect()}
    assert set(got) == {"hot", "b"}
    for station, r in got.items():
        rows = [t for t in train.collect() if t.station == station]
        x, y = np.array([[t.u, t.v] for t in rows]), np.array([t.label for t in rows])
        w, b = descend(x, y, 0.05, epochs)
        assert np.allclose(r.weights, w, atol=1e-9) and r.bias == pytest.approx(b, abs=1e-9)
    scored = models.score_logistic(train, model, ["u", "v"]).first()
    r = got[scored.station]
    z = r.weights[0] * scored.u + r.weights[1] * scored.v + r.bias
    assert scored.lstm_prob == pytest.approx(1 / (1 + np.exp(-z)))


def test_pooled_model(train, fresh):
    path = fresh("model")
    models.save_model(models.fit_pooled_logistic(train, ["u", "v"]), path)
    model = models.load_model(path)
    want = {(r.u, r.v): r.probability[1] for r in model.transform(train).collect()}
    for r in models.score_pooled_logistic(train, model).collect():
        assert r.lstm_prob == pytest.approx(want[(r.u, r.v)])


def test_trees_learn(spark, fresh):
    rng = np.random.default_rng(4)
    rows = [("s", [[float(a), float(b)]], int(a > 0)) for a, b in rng.normal(size=(300, 2))]
    df = spark.createDataFrame(rows, "station string, window array<array<double>>, label int")
    path = fresh("trees")
    models.save_model(models.fit_trees(df, iterations=3), path)
    scored = models.score_trees(df, models.load_model(path))
    report = models.accuracy(scored, ["transformer_prob"]).first()
    assert report.accuracy_transformer > 0.95


def test_external_model(spark):
    rows = [("a", 1, [[1.0, 2.0], [3.0, 4.0]]), ("b", 2, [[0.0, 0.0], [1.0, 1.0]])]
    df = spark.createDataFrame(rows, "k string, n int, window array<array<double>>")
    got = models.score_external(df, lambda x: x[:, -1, 0] - x[:, 0, 1]).collect()
    assert {(r.k, r.n): r.external_prob for r in got} == {("a", 1): 1.0, ("b", 2): 1.0}


def platt_by_descent(p, y, epochs=60000, reg=10.0):
    z, a, b = np.log(p / (1 - p)), 1.0, 0.0
    for _ in range(epochs):
        miss = 1 / (1 + np.exp(-(a * z + b))) - y
        a, b = (
            a - 0.1 * ((miss * z).mean() + reg / len(z) * (a - 1)),
            b - 0.1 * (miss.mean() + reg / len(z) * b),
        )
    return a, b


def test_platt(spark):
    rng = np.random.default_rng(6)
    rows = []
    for market, n in (("hot", 400), ("b", 25), ("one", 1)):
        p = rng.uniform(0.02, 0.98, n)
        rows += [(market, float(x), int(rng.random() < 0.3 + 0.4 * x)) for x in p]
    rows.append(("hot", None, 1))
    df = spark.createDataFrame(rows, "market string, model_prob double, outcome int").repartition(5)
    fitted = calibrate.fit_platt(df)
    got = {r.market: (r.a, r.b) for r in fitted.collect()}
    for market in ("hot", "b", "one"):
        p, y = np.array([r[1:] for r in rows if r[0] == market and r[1] is not None]).T
        assert got[market] == pytest.approx(platt_by_descent(p, y), abs=1e-6)
    moved = calibrate.apply_platt(df, fitted).where("model_prob is not null").collect()
    assert all(0 < r.model_prob < 1 for r in moved) and len(moved) == len(rows) - 1


def test_platt_of_overconfident_members(spark):
    rng = np.random.default_rng(8)
    rows, bent = [], {}
    for scale in (1, 2, 3, 4, 6):
        z = rng.normal(0, scale, 600)
        y = np.where(rng.random(600) < 0.35, z < 0, z > 0).astype(int)
        bent[f"s{scale}"] = (z, y)
    bent["sure and wrong"] = (rng.normal(0, 6, 600) + 5, np.zeros(600, int))
    bent["one class"] = (rng.normal(0, 1, 50), np.ones(50, int))
    for name, (z, y) in bent.items():
        rows += [(name, float(1 / (1 + np.exp(-a))), int(b)) for a, b in zip(z, y)]
    df = spark.createDataFrame(rows, "market string, model_prob double, outcome int")
    for r in calibrate.fit_platt(df).collect():
        p = np.array([x[1] for x in rows if x[0] == r.market])
        y = np.array([x[2] for x in rows if x[0] == r.market])
        z = np.log(np.clip(p, 1e-6, 1 - 1e-6) / (1 - np.clip(p, 1e-6, 1 - 1e-6)))
        miss = 1 / (1 + np.exp(-(r.a * z + r.b))) - y
        # A convex loss: where its gradient is zero is the minimum.
        assert abs((miss * z).mean() + 10 / len(z) * (r.a - 1)) < 1e-8, r.market
        assert abs(miss.mean() + 10 / len(z) * r.b) < 1e-8, r.market


def test_platt_of_a_market_without_a_name(spark):
    rng = np.random.default_rng(4)
    rows = [(None if i % 2 else "a", float(rng.uniform(0.1, 0.9)), int(rng.random() < 0.6)) for i in range(60)]
    rows += [("no outcome", 0.3, None)]
    df = spark.createDataFrame(rows, "market string, model_prob double, outcome int").repartition(4)
    fitted = calibrate.fit_platt(df)
    got = {r.market: (r.a, r.b) for r in fitted.collect()}
    p, y = np.array([r[1:] for r in rows if r[0] is None]).T
    assert set(got) == {None, "a"} and got[None] == pytest.approx(platt_by_descent(p, y), abs=1e-6)
    moved = calibrate.apply_platt(df, fitted).collect()
    assert len(moved) == len(rows)  # no row is lost; a market without a fit keeps its probability
    assert [r.model_prob for r in moved if r.market == "no outcome"] == pytest.approx([0.3])


def test_platt_ends_where_no_step_gets_further(spark, monkeypatch):
    rng = np.random.default_rng(2)
    rows = [("a", float(rng.uniform(0.1, 0.9)), int(rng.random() < 0.5)) for _ in range(200)]
    df = spark.createDataFrame(rows, "market string, model_prob double, outcome int")
    exact = calibrate.fit_platt(df).first()
    least = calibrate.fit_platt(df, tolerance=0.0).first()  # ends at the rounding of the sums
    assert (least.a, least.b) == pytest.approx((exact.a, exact.b), abs=1e-8)
    monkeypatch.setattr(calibrate, "FAILED", -1.0)
    with pytest.raises(ValueError, match="1 of the keys"):
        calibrate.fit_platt(df, tolerance=0.0)


def test_accuracy_counts_one_half_as_yes(spark):
    df = spark.createDataFrame([(0.5, 1), (0.49, 1), (0.1, 0), (0.9, 0)], "lstm_prob double, y int")
    assert models.accuracy(df, ["lstm_prob"], "y").first()[0] == 0.5


def test_training_windows_are_spread_by_rows(spark):
    """One file or task with many windows becomes several tasks with all of them."""
    rows = spark.range(1050).coalesce(1)
    dealt = models.spread(rows, 100)
    assert dealt.rdd.getNumPartitions() == 11
    assert max(dealt.rdd.glom().map(len).collect()) <= 110
    assert sorted(r.id for r in dealt.collect()) == list(range(1050))
    assert models.spread(rows, 2000).rdd.getNumPartitions() == 1
    assert models.spread(rows.where("id < 0"), 100).count() == 0


def test_one_crowded_task_among_many_is_spread(spark):
    """Many small tasks do not hide one that has nearly all windows."""
    few = spark.range(1000, 1020, 1, 20)
    rows = spark.range(1000).coalesce(1).union(few)
    dealt = models.spread(rows, 100)
    assert max(dealt.rdd.glom().map(len).collect()) <= 110
    assert sorted(r.id for r in dealt.collect()) == list(range(1020))
    assert models.spread(few, 100).rdd.getNumPartitions() == 20
