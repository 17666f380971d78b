"""The descent over several tasks and the recurrent cell."""

import datetime as dt
import tempfile
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from edgeframe.operators import descent, models, recurrent
from edgeframe.operators.descent import Logistic, descend

DAY = dt.date(2021, 1, 1)
SCHEMA = "station string, date date, window array<array<double>>, label int"


def loss(cell, state, x, y, n):
    p = cell.probabilities(state, x)
    penalty = 0.5 * cell.decay * n.sum() * (cell.parameters(state) ** 2).sum()
    return -(n * (y * np.log(p) + (1 - y) * np.log(1 - p))).sum() + penalty


def test_gradient_is_that_of_finite_differences():
    rng = np.random.default_rng(0)
    cell = recurrent.Cell(2, units=3, decay=0.01)
    x, y, n = rng.normal(size=(7, 10)), rng.integers(0, 2, 7).astype(float), rng.integers(1, 4, 7)
    state = cell.start(10)
    state[1 : 1 + cell.size] += rng.normal(scale=0.3, size=cell.size)
    got, step = cell.gradient(state, x, y, n), 1e-6
    for i in range(cell.size):
        up, down = state.copy(), state.copy()
        up[1 + i] += step
        down[1 + i] -= step
        want = (loss(cell, up, x, y, n) - loss(cell, down, x, y, n)) / (2 * step)
        assert got[i] == pytest.approx(want, abs=1e-5)


def test_rows_of_a_long_part_are_all_used(monkeypatch):
    rng = np.random.default_rng(1)
    cell = recurrent.Cell(1, units=2)
    x, y, n = rng.normal(size=(11, 4)), rng.integers(0, 2, 11).astype(float), np.ones(11)
    whole = cell.gradient(cell.start(4), x, y, n)
    monkeypatch.setattr(recurrent, "SLICE", 3)
    assert np.allclose(cell.gradient(cell.start(4), x, y, n), whole)


@pytest.fixture(scope="module")
def ordered(spark):
    """A label that only the order tells: was the high step before the low one? Means are equal
    and the last step says nothing."""
    rng = np.random.default_rng(2)
    rows = []
    for station, count in (("a", 300), ("b", 120)):
        for i in range(count):
            window = rng.normal(scale=0.1, size=8)
            high, low = rng.choice(7, size=2, replace=False)
            window[high] += 2.0
            window[low] -= 2.0
            rows.append(
                (station, DAY + dt.timedelta(days=i), [[float(v)] for v in window], int(high < low))
            )
    return spark.createDataFrame(rows, SCHEMA).cache()


def test_learns_order_that_summaries_cannot_tell(ordered):
    cell = recurrent.Cell(1, units=6, rate=0.05)
    known = F.dayofyear("date") % 4 != 0
    model = recurrent.fit_recurrent(ordered.where(known), 1, epochs=150, cell=cell)
    scored = recurrent.score_recurrent(ordered.where(~known), model, cell)
    steps = F.flatten("window")
    plain = ordered.withColumns(
        {"m": F.aggregate(steps, F.lit(0.0), lambda a, v: a + v) / 8, "z": F.element_at(steps, -1)}
    )
    logistic = models.fit_logistic(plain.where(known), ["m", "z"])
    compared = models.score_logistic(plain.where(~known), logistic, ["m", "z"], "plain_prob")
    ours = models.accuracy(scored, ["lstm_prob"]).first()[0]
    theirs = models.accuracy(compared, ["plain_prob"]).first()[0]
    assert ours > 0.9 and ours > theirs + 0.2


@pytest.mark.parametrize("piece_rows,tasks", [(1000, 1), (60, 8), (7, 5)])
def test_fit_is_the_same_over_any_tasks(ordered, piece_rows, tasks):
    cell = recurrent.Cell(1, units=2)
    model = recurrent.fit_recurrent(
        ordered, 1, epochs=3, cell=cell, piece_rows=piece_rows, tasks=tasks
    )
    got = {r.station: np.array(r.state) for r in model.collect()}
    assert set(got) == {"a", "b"}
    for station, state in got.items():
        rows = [r for r in ordered.collect() if r.station == station]
        x = np.array([np.ravel(r.window) for r in rows])
        y = np.array([float(r.label) for r in rows])
        want = cell.start(8)
        for _ in range(3):
            want = cell.update(want, cell.gradient(want, x, y, np.ones(len(y))) / len(y))
        assert np.allclose(state, want, atol=1e-9)


def test_rounds_go_on_where_the_last_one_ended(ordered):
    x = F.array(F.col("window")[0][0])
    runs = [
        descend(ordered, x, "label", Logistic(0.1), 5, piece_rows, round_epochs=size)
        for size, piece_rows in ((100, 1000), (2, 1000), (3, 20))
    ]
    states = [{r.station: r.state for r in run.collect()} for run in runs]
    for other in states[1:]:
        assert set(other) == set(states[0]) == {"a", "b"}
        assert all(np.allclose(other[k], v, atol=1e-12) for k, v in states[0].items())


def test_odd_rows(spark):
    good = [(None, DAY, [[1.0], [2.0]], 1), (None, DAY, [[1.0], [0.0]], 0)] * 40
    odd = [
        (None, DAY, [[float("nan")], [1.0]], 1),
        (None, DAY, [[None], [1.0]], 1),
        (None, DAY, None, 1),
        (None, None, [[5.0], [5.0]], None),
        ("only odd", DAY, [[float("inf")], [1.0]], 1),
    ]
    rows = spark.createDataFrame(good + odd, SCHEMA)
    cell = recurrent.Cell(1, units=2)
    model = recurrent.fit_recurrent(rows, 1, epochs=4, cell=cell, piece_rows=1)
    states = {r.station: r.state for r in model.collect()}
    assert set(states) == {None}
    clean = recurrent.fit_recurrent(
        spark.createDataFrame(good, SCHEMA), 1, epochs=4, cell=cell, tasks=1
    )
    assert np.allclose(clean.first().state, states[None], atol=1e-9)
    scored = recurrent.score_recurrent(rows, model, cell).collect()
    assert len(scored) == 85
    assert sum(r.lstm_prob is None for r in scored) == 4
    assert recurrent.score_recurrent(rows.limit(0), model, cell).count() == 0


def test_empty_table_has_no_model(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert recurrent.fit_recurrent(empty, 1, epochs=2).collect() == []


def test_a_task_fits_one_key_after_the_other(spark):
    """So it has the rows of one key at a time, however many keys it is given."""

    class Turns:
        """Its state is (which key of the task this is, the keys begun when it ended)."""

        begun = 0

        def start(self, width):
            self.begun += 1
            return np.array([float(self.begun), 0.0])

        def gradient(self, state, x, y, n):
            return len(x) * np.array([state[0], self.begun])

        def update(self, state, gradient):
            return gradient

    rows = spark.range(600).select(
        (F.col("id") % 20).cast("string").alias("station"),
        F.array(F.col("id")).alias("x"),
        F.lit(1).alias("label"),
    )
    fitted = descend(rows, F.col("x"), "label", Turns(), 3, tasks=1).collect()
    assert sorted(r.state[0] for r in fitted) == list(range(1, 21))
    assert all(r.state[0] == r.state[1] for r in fitted)


def test_pieces_of_a_cut_key_are_not_kept_in_memory():
    rng, learner = np.random.default_rng(3), Logistic(0.1)
    parts = [(rng.normal(size=(1000, 50)), rng.integers(0, 2, 1000) * 1.0) for _ in range(20)]

    def batches():
        for x, y in parts:
            x = pa.ListArray.from_arrays(pa.array(np.arange(1001, dtype="int32") * 50), pa.array(x.ravel()))
            same = [pa.array([7] * 1000, pa.int32()), pa.array(["a"] * 1000)]
            rest = [x, pa.array(y), pa.array([1] * 1000), pa.nulls(1000, pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays([*same, *rest], schema=descent._ARROW)

    with tempfile.TemporaryFile() as file:
        tracemalloc.start()
        before = pa.total_allocated_bytes()
        held = descent._Held(batches(), learner, file)
        got = held.gradient("a")
        used = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
    x, y = (np.concatenate(column) for column in zip(*parts))
    assert np.allclose(got, learner.gradient(learner.start(50), x, y, np.ones(len(x))))
    # All numbers take 8 MB.
    assert used < 4e6 and pa.total_allocated_bytes() - before < 2e6
