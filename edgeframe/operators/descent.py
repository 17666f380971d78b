"""Full-batch descent of one model per key, with the rows of a key in as many tasks as it needs.

Equal rows of a key are one row with a count. A key with at most ``piece_rows`` distinct rows is
descended by itself: keys are grouped, and a task has the rows of one key in memory at a time,
through all epochs, however many keys it is given. Tasks get about ``TASK_ROWS`` rows each.

A larger key is cut by a hash of its values into pieces, which ranges of (key, piece) place once;
``piece_rows`` bounds what is computed in one place and takes no other part in the result. A round
is one barrier stage. Each of its tasks keeps its rows in an unnamed local file and reads it batch
by batch in every epoch, so memory does not grow with the rows. The tasks add up the gradients of
their keys and exchange these sums and nothing else. All of them add the sums in the same order and
so keep the same model. Spark answers an exchange after one second, whatever its size, so an epoch
takes a second longer if any key is cut. After ``round_epochs`` epochs the models are written to the
shared folder, and the next round starts from there.

Barrier stages, which run only if a key is cut, need all their tasks at once: ``tasks`` is at most
the number of slots, local disks have to hold the rows of the cut keys, and Spark refuses them under
dynamic allocation. A lost executor repeats the running round from its last written models.

Rows with a null or non-finite input or label take no part; a null key is a key. Copies cost
nothing, and a key of copies can be cut anywhere else. A key without rows left has no model; an
empty table gives none.
"""

from __future__ import annotations

import base64
import json
import tempfile
from collections.abc import Iterable, Iterator
from typing import Protocol

import numpy as np
import pyarrow as pa
from pyspark import BarrierTaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from edgeframe.schemas import record
from edgeframe.storage import remove, scratch

ROUND_EPOCHS = 100
PIECE_ROWS = 262_144
#: Rows of whole keys that a task is given; fewer where there are more slots than that fills.
TASK_ROWS = 100_000

_STATE = record(
    _task="int", station="string", _state=T.ArrayType(T.DoubleType()), _lead=T.BooleanType()
)
_MODEL = record(station="string", state=T.ArrayType(T.DoubleType()))


class Learner(Protocol):
    """What is descended: a flat state per key, and the gradient of rows under it."""

    def start(self, width: int) -> np.ndarray:
        """The state before the first epoch, for inputs of ``width`` numbers."""

    def gradient(
        self, state: np.ndarray, x: np.ndarray, y: np.ndarray, n: np.ndarray
    ) -> np.ndarray:
        """Sum over rows of ``n`` times the gradient of their loss."""

    def update(self, state: np.ndarray, gradient: np.ndarray) -> np.ndarray:
        """The state after a step along the mean gradient."""


def slots(spark: SparkSession) -> int:
    """Tasks that run at once: cores of the application over cores of a task."""
    cores = spark.sparkContext.defaultParallelism
    return max(1, cores // int(spark.conf.get("spark.task.cpus", "1")))


def descend(
    train: DataFrame,
    inputs: Column,
    label: str,
    learner: Learner,
    epochs: int,
    piece_rows: int = PIECE_ROWS,
    tasks: int | None = None,
    round_epochs: int = ROUND_EPOCHS,
) -> DataFrame:
    """(station, state) after ``epochs`` steps; ``inputs`` is an array of numbers per row."""
    spark = train.sparkSession
    tasks = tasks or slots(spark)
    folder = scratch(spark, "descent")
    _write(_distinct(train, inputs, label), f"{folder}/rows")
    rows = spark.read.parquet(f"{folder}/rows")
    sizes = rows.groupBy(F.col("station").alias("_key")).agg(F.count(F.lit(1)).alias("_rows"))
    _write(sizes, f"{folder}/sizes")
    sizes = spark.read.parquet(f"{folder}/sizes")
    large = sizes.where(F.col("_rows") > piece_rows)

    any_large = not large.isEmpty()
    own = rows.join(large, F.col("station").eqNullSafe(F.col("_key")), "left_anti") if any_large else rows
    count = sizes.where(F.col("_rows") <= piece_rows).agg(F.sum("_rows")).first()[0] or 0
    _write(_whole(own, max(tasks, -(-count // TASK_ROWS)), learner, epochs), f"{folder}/models")
    found = spark.read.schema(_MODEL).parquet(f"{folder}/models")
    if any_large:
        found = found.unionByName(_cut(rows, large, folder, learner, epochs, piece_rows, tasks, round_epochs))
    for name in ("rows", "sizes", "placed"):
        remove(spark, f"{folder}/{name}")
    return found


def _whole(rows: DataFrame, parts: int, learner: Learner, epochs: int) -> DataFrame:
    """(station, state) of keys that are not cut, one key at a time."""

    def fit(key: tuple, table: pa.Table) -> pa.Table:
        x, y, n = _arrays(table)
        state, total = learner.start(x.shape[1]), n.sum()
        for _ in range(epochs):
            state = learner.update(state, learner.gradient(state, x, y, n) / total)
        columns = [pa.array([key[0].as_py()], pa.string()), pa.array([state.tolist()], pa.list_(pa.float64()))]
        return pa.Table.from_arrays(columns, names=_MODEL.names)

    return rows.repartition(parts, "station").groupBy("station").applyInArrow(fit, _MODEL)


def _cut(
    rows: DataFrame,
    large: DataFrame,
    folder: str,
    learner: Learner,
    epochs: int,
    piece_rows: int,
    tasks: int,
    round_epochs: int,
) -> DataFrame:
    """(station, state) of the keys that are cut over several tasks."""
    spark = rows.sparkSession
    _write(_placed(rows, large, piece_rows, tasks), f"{folder}/placed")
    placed = spark.read.parquet(f"{folder}/placed")
    states, done = None, 0
    while states is None or done < epochs:
        steps = min(round_epochs, epochs - done)
        given = placed if states is None else placed.unionByName(
            states.drop("_lead"), allowMissingColumns=True
        )
        if states is None:
            given = given.withColumn("_state", F.lit(None).cast("array<double>"))
        work = given.select("_task", "station", "_x", "_y", "_n", "_state")
        found = work.repartitionById(tasks, F.col("_task")).mapInArrow(
            _round(learner, steps), _STATE, barrier=True
        )
        done += steps
        _write(found, f"{folder}/states-{done}")
        states = spark.read.schema(_STATE).parquet(f"{folder}/states-{done}")
    return states.where("_lead").select("station", F.col("_state").alias("state"))


def _write(df: DataFrame, path: str) -> None:
    df.write.parquet(path)


def _distinct(train: DataFrame, inputs: Column, label: str) -> DataFrame:
    """Usable rows, equal ones as one row with their count ``_n``."""
    limit = F.lit(float("inf"))  # NaN is larger in Spark's order

    def finite(value: Column) -> Column:
        return value.isNotNull() & (F.abs(value) < limit)

    return (
        train.select(
            "station",
            inputs.cast("array<double>").alias("_x"),
            F.col(label).cast("double").alias("_y"),
        )
        .where(finite(F.col("_y")) & F.forall("_x", finite))
        .groupBy("station", "_x", "_y")
        .agg(F.count(F.lit(1)).alias("_n"))
    )


def _placed(rows: DataFrame, large: DataFrame, piece_rows: int, tasks: int) -> DataFrame:
    """Rows of the large keys with their task."""
    pieces = large.select("_key", F.ceil(F.col("_rows") / F.lit(piece_rows)).alias("_pieces"))
    return (
        rows.join(pieces, F.col("station").eqNullSafe(F.col("_key")))
        .withColumn("_piece", F.pmod(F.xxhash64("_x", "_y"), F.col("_pieces")))
        .repartitionByRange(tasks, "station", "_piece")
        .select("station", "_x", "_y", "_n", F.spark_partition_id().alias("_task"))
    )


def _arrays(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Inputs, labels and counts of rows whose inputs have one length."""
    x = table["_x"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return x.reshape(len(table), -1), table["_y"].to_numpy(), table["_n"].to_numpy().astype(float)


def _round(learner: Learner, epochs: int):
    """The function of one task in a round of ``epochs`` epochs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = BarrierTaskContext.get()
        with tempfile.TemporaryFile() as file:
            held = _Held(batches, learner, file)
            # What the tasks share: (key, rows) of each one's keys, in that task's order.
            told = [json.loads(m) for m in context.allGather(json.dumps(list(held.sizes.items())))]
            total = {key: sum(n for listed in told for k, n in listed if k == key) for key in held.sizes}
            for _ in range(epochs):
                mine = b"".join(held.gradient(key).tobytes() for key in held.sizes)
                sent = context.allGather(base64.b64encode(mine).decode("ascii"))
                for key, gradient in _added(told, sent, set(held.sizes)).items():
                    held.states[key] = learner.update(held.states[key], gradient / total[key])

        me = context.partitionId()
        first = {}
        for task, listed in enumerate(told):
            for key, _ in listed:
                first.setdefault(key, task)
        for key, state in held.states.items():
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([me], pa.int32()),
                    pa.array([key], pa.string()),
                    pa.array([state.tolist()], pa.list_(pa.float64())),
                    pa.array([first[key] == me]),
                ],
                names=_STATE.names,
            )

    return run


_ARROW = pa.schema(
    [
        ("_task", pa.int32()),
        ("station", pa.string()),
        ("_x", pa.list_(pa.float64())),
        ("_y", pa.float64()),
        ("_n", pa.int64()),
        ("_state", pa.list_(pa.float64())),
    ]
)


class _Held:
    """The rows of a task in a local file, read batch by batch, and the states of its keys."""

    def __init__(self, batches: Iterable[pa.RecordBatch], learner: Learner, file):
        self.learner, self.file = learner, file
        self.parts, self.sizes, self.states = {}, {}, {}
        for batch in batches:
            table = pa.Table.from_batches([batch], _ARROW)
            given = table.filter(table["_state"].is_valid())
            for key, state in zip(given["station"].to_pylist(), given["_state"].to_pylist()):
                self.states[key] = np.array(state)
            self._keep(table.filter(table["_y"].is_valid()).combine_chunks())

    def _keep(self, table: pa.Table) -> None:
        # A null key gets the code after all others.
        coded = table["station"].combine_chunks().dictionary_encode()
        names = [*coded.dictionary.to_pylist(), None]
        codes = coded.indices.fill_null(len(names) - 1).to_numpy(zero_copy_only=False)
        for code, key in enumerate(names):
            at = np.flatnonzero(codes == code)
            if not len(at):
                continue
            x, y, n = _arrays(table.take(pa.array(at)))
            self.parts.setdefault(key, []).append((self.file.tell(), x.shape))
            for values in (x, y, n):
                self.file.write(values.tobytes())
            self.sizes[key] = self.sizes.get(key, 0.0) + float(n.sum())
            if key not in self.states:
                self.states[key] = self.learner.start(x.shape[1])

    def gradient(self, key: str | None) -> np.ndarray:
        """Sum over all rows of ``key``, of which one batch is in memory at a time."""
        total = 0.0
        for start, (rows, width) in self.parts[key]:
            self.file.seek(start)
            values = np.frombuffer(self.file.read(8 * rows * (width + 2)))
            x, y, n = np.split(values, [rows * width, rows * (width + 1)])
            total = total + self.learner.gradient(self.states[key], x.reshape(rows, width), y, n)
        return total


def _added(told: list, sent: list[str], wanted: set) -> dict:
    """Sums of the wanted keys over all tasks, added in the order of the tasks."""
    sums = {}
    for listed, message in zip(told, sent):
        if not any(key in wanted for key, _ in listed):
            continue
        parts = np.frombuffer(base64.b64decode(message)).reshape(len(listed), -1)
        for (key, _), part in zip(listed, parts):
            if key in wanted:
                sums[key] = sums[key] + part if key in sums else part
    return sums


class Logistic:
    """Logistic loss of a linear model by plain steps; the state is the weights, then the bias."""

    def __init__(self, rate: float):
        self.rate = rate

    def start(self, width: int) -> np.ndarray:
        return np.zeros(width + 1)

    def gradient(self, state, x, y, n):
        miss = n * (1.0 / (1.0 + np.exp(-(x @ state[:-1] + state[-1]))) - y)
        return np.append(miss @ x, miss.sum())

    def update(self, state, gradient):
        return state - self.rate * gradient
