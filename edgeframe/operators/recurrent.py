"""A learner that uses the order of the window: one gated recurrent cell with memory per station.

The cell (input, forget and output gates, a candidate and a memory) reads the steps of a window
from the oldest to the newest; a logistic unit on its last output gives the probability. It is
fitted by ``operators.descent``: each task runs its rows forward, sends the errors back through
all steps, and the gradients of a station are summed over the tasks that hold it. Steps are
Adam's, full batch, from a start that depends on the seed only, so a fit repeats.

Windows of a station must have equal lengths. Windows with a null or non-finite number, or
without a label, are not learned from; such a window has a null probability when scored, as has
a station without a model.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from edgeframe.operators.blocks import BLOCK, day_blocks
from edgeframe.operators.descent import PIECE_ROWS, descend

#: Rows run through the steps at a time; bounds the activations a task holds.
SLICE = 8192

# Adam's published constants.
DECAY_MEAN, DECAY_SQUARE, TINY = 0.9, 0.999, 1e-8


def _logistic(z: np.ndarray) -> np.ndarray:
    return 0.5 * (1.0 + np.tanh(0.5 * z))


class Cell:
    """The recurrent cell as a learner; its state is (steps taken, parameters, two moments)."""

    def __init__(
        self, features: int, units: int = 8, rate: float = 0.02, decay: float = 1e-3, seed: int = 7
    ):
        self.features, self.units = features, units
        self.rate, self.decay, self.seed = rate, decay, seed
        # One matrix for the four gates over (input, last output, one), then the output unit.
        self.shape = features + units + 1, 4 * units
        self.gates = self.shape[0] * self.shape[1]
        self.size = self.gates + units + 1

    def parameters(self, state: np.ndarray) -> np.ndarray:
        return state[1 : 1 + self.size]

    def start(self, width: int) -> np.ndarray:
        rng = np.random.default_rng(self.seed)
        gates = rng.normal(scale=1.0 / np.sqrt(self.shape[0]), size=self.shape)
        gates[-1] = 0.0
        gates[-1, self.units : 2 * self.units] = 1.0  # memory is kept at first
        out = rng.normal(scale=1.0 / np.sqrt(self.units), size=self.units)
        return np.concatenate([[0.0], gates.ravel(), out, [0.0], np.zeros(2 * self.size)])

    def _split(self, parameters: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
        gates = parameters[: self.gates].reshape(self.shape)
        return gates, parameters[self.gates : -1], parameters[-1]

    def _forward(self, parameters: np.ndarray, x: np.ndarray):
        """Probabilities of windows (rows, steps, features), and what each step computed."""
        gates, out, bias = self._split(parameters)
        u, rows = self.units, len(x)
        h, c = np.zeros((rows, u)), np.zeros((rows, u))
        ones, trace = np.ones((rows, 1)), []
        for step in range(x.shape[1]):
            seen = np.hstack([x[:, step], h, ones])
            z = seen @ gates
            opened = _logistic(z[:, : 3 * u])  # input, forget, output
            fresh, before = np.tanh(z[:, 3 * u :]), c
            c = opened[:, u : 2 * u] * before + opened[:, :u] * fresh
            bent = np.tanh(c)
            h = opened[:, 2 * u :] * bent
            trace.append((seen, opened, fresh, before, bent))
        return _logistic(h @ out + bias), h, trace

    def probabilities(self, state: np.ndarray, windows: np.ndarray) -> np.ndarray:
        """Of flat windows (rows, steps x features)."""
        parts = [
            self._forward(self.parameters(state), part)[0] for part in self._slices(windows)
        ]
        return np.concatenate(parts) if parts else np.empty(0)

    def _slices(self, flat: np.ndarray) -> Iterator[np.ndarray]:
        x = flat.reshape(len(flat), -1, self.features)
        for at in range(0, len(x), SLICE):
            yield x[at : at + SLICE]

    def gradient(self, state, x, y, n) -> np.ndarray:
        """Sum over rows of ``n`` times the gradient of their log loss, penalty included."""
        parameters = self.parameters(state)
        total = self.decay * n.sum() * parameters
        at = 0
        for part in self._slices(x):
            end = at + len(part)
            total = total + self._backward(parameters, part, y[at:end], n[at:end])
            at = end
        return total

    def _backward(self, parameters, x, y, n) -> np.ndarray:
        gates, out, _ = self._split(parameters)
        u = self.units
        p, h, trace = self._forward(parameters, x)
        miss = n * (p - y)
        d_gates = np.zeros(self.shape)
        d_h, d_c = np.outer(miss, out), np.zeros_like(h)
        for seen, opened, fresh, before, bent in reversed(trace):
            i, f, o = opened[:, :u], opened[:, u : 2 * u], opened[:, 2 * u :]
            d_c = d_c + d_h * o * (1.0 - bent * bent)
            d_opened = np.hstack([d_c * fresh, d_c * before, d_h * bent])
            d_z = np.hstack([d_opened * opened * (1.0 - opened), d_c * i * (1.0 - fresh * fresh)])
            d_gates += seen.T @ d_z
            d_h = d_z @ gates[self.features : -1].T
            d_c = d_c * f
        return np.concatenate([d_gates.ravel(), h.T @ miss, [miss.sum()]])

    def update(self, state, gradient) -> np.ndarray:
        t = state[0] + 1.0
        parameters, mean, square = np.split(state[1:], 3)
        mean = DECAY_MEAN * mean + (1.0 - DECAY_MEAN) * gradient
        square = DECAY_SQUARE * square + (1.0 - DECAY_SQUARE) * gradient * gradient
        step = (mean / (1.0 - DECAY_MEAN**t)) / (
            np.sqrt(square / (1.0 - DECAY_SQUARE**t)) + TINY
        )
        return np.concatenate([[t], parameters - self.rate * step, mean, square])


def fit_recurrent(
    train: DataFrame,
    features: int,
    label: str = "label",
    epochs: int = 120,
    cell: Cell | None = None,
    piece_rows: int = PIECE_ROWS,
    tasks: int | None = None,
) -> DataFrame:
    """(station, state) of the cell of each station, from its column ``window``."""
    learner = cell or Cell(features)
    return descend(train, F.flatten("window"), label, learner, epochs, piece_rows, tasks)


def score_recurrent(
    df: DataFrame,
    model: DataFrame,
    cell: Cell,
    out: str = "lstm_prob",
    block: Column | None = None,
) -> DataFrame:
    """Add the probability of the station's cell.

    A state has some thousand numbers, so it is sent once per (station, block of days) and not
    with every row; a task holds the windows of one block at a time.
    """
    kept = df.columns
    schema = T.StructType([*df.schema.fields, T.StructField(out, T.DoubleType())])
    limit = F.lit(float("inf"))
    flat = F.flatten("window").cast("array<double>")
    usable = F.forall(flat, lambda v: v.isNotNull() & (F.abs(v) < limit))
    rows = df.withColumns(
        {BLOCK: day_blocks() if block is None else block, "_flat": F.when(usable, flat)}
    )
    parameters = F.slice("state", 1, 1 + cell.size)
    states = model.select(F.col("station").alias("_key"), parameters.alias("_state"))
    sent = (
        rows.select("station", BLOCK)
        .distinct()
        .join(states, F.col("station").eqNullSafe(F.col("_key")))
        .select("_key", F.col(BLOCK).alias("_at"), "_state")
    )

    def score(windows: pa.Table, states: pa.Table) -> pa.Table:
        flats = windows["_flat"].combine_chunks()
        ready = flats.is_valid().to_numpy(zero_copy_only=False)
        p = np.full(len(windows), np.nan)
        if len(states) and ready.any():
            values = flats.flatten().to_numpy(zero_copy_only=False)
            state = np.array(states["_state"][0].as_py())
            p[ready] = cell.probabilities(state, values.reshape(int(ready.sum()), -1))
        mask = ~ready if len(states) else np.ones(len(windows), bool)
        return windows.select(kept).append_column(out, pa.array(p, mask=mask))

    # Rows without a date have a null block; keys are compared with nulls as equals.
    groups = rows.groupBy("station", BLOCK).cogroup(sent.groupBy("_key", "_at"))
    return groups.applyInArrow(score, schema)
