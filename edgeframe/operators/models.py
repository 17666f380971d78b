"""Two genuinely different forecasters and their blend.

Member A is a logistic model on window summaries, one per station; member B is boosted
trees on the whole flattened window, trained over all stations.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from edgeframe.defaults import FEATURES, GD_EPOCHS, GD_RATE
from edgeframe.functions.contracts import blend
from edgeframe.functions.numeric import sigmoid
from edgeframe.operators.dataset import KEY, summary_names
from edgeframe.operators.descent import PIECE_ROWS, Logistic, descend

# --- member A: logistic model per station -------------------------------------------


def fit_logistic(
    train: DataFrame,
    names: Sequence[str],
    label: str = "label",
    rate: float = GD_RATE,
    epochs: int = GD_EPOCHS,
    local_rows: int = PIECE_ROWS,
    tasks: int | None = None,
) -> DataFrame:
    """(station, weights, bias) after ``epochs`` full-batch gradient steps from zero.

    A station with more than ``local_rows`` rows is cut over several tasks; see
    ``operators.descent``.
    """
    fitted = descend(
        train, F.array(*names), label, Logistic(rate), epochs, local_rows, tasks
    )
    weights = F.slice("state", 1, len(names))
    return fitted.select(*KEY, weights.alias("weights"), F.element_at("state", -1).alias("bias"))


def linear(names: Sequence[str]) -> Column:
    """Dot product of the named columns with the ``weights`` array, plus ``bias``."""
    terms = [F.col("weights")[i] * F.col(n) for i, n in enumerate(names)]
    return sum(terms[1:], terms[0]) + F.col("bias")


def scaled(df: DataFrame, statistics: DataFrame, names: Sequence[str]) -> DataFrame:
    """Second standardisation: summary columns by their train mean and deviation."""
    joined = df.join(statistics, KEY)
    return joined.withColumns(
        {n: (F.col(n) - F.col(f"mean_{n}")) / F.col(f"std_{n}") for n in names}
    ).select(*df.columns)


def score_logistic(
    df: DataFrame, model: DataFrame, names: Sequence[str], out: str = "lstm_prob"
) -> DataFrame:
    """Add the probability of the station's logistic model; columns only, no Python."""
    joined = df.join(model, KEY)
    return joined.withColumn(out, sigmoid(linear(names))).drop("weights", "bias")


def fit_pooled_logistic(
    train: DataFrame, names: Sequence[str], label: str = "label"
) -> PipelineModel:
    """One logistic model over all stations."""
    assembler = VectorAssembler(inputCols=list(names), outputCol="_x")
    learner = LogisticRegression(featuresCol="_x", labelCol=label)
    return PipelineModel([assembler, learner.fit(assembler.transform(train))])


def score_pooled_logistic(
    df: DataFrame, model: PipelineModel, out: str = "lstm_prob"
) -> DataFrame:
    """Add the pooled model's probability as one column expression over its inputs."""
    assembler, fitted = model.stages
    terms = [
        F.lit(float(c)) * F.col(n)
        for c, n in zip(fitted.coefficients, assembler.getInputCols())
    ]
    return df.withColumn(out, sigmoid(sum(terms[1:], terms[0]) + F.lit(float(fitted.intercept))))


# --- member B: boosted trees over all stations --------------------------------------

#: Training windows of a task at most; the learner keeps them and reads them per level.
TREE_ROWS = 100_000


def flat_window(df: DataFrame) -> DataFrame:
    """Add the window as one vector of steps x features numbers."""
    return df.withColumn("_x", array_to_vector(F.flatten("window")))


def fit_trees(
    train: DataFrame,
    label: str = "label",
    iterations: int = 10,
    depth: int = 3,
    seed: int = 13,
) -> PipelineModel:
    learner = GBTClassifier(
        featuresCol="_x", labelCol=label, maxIter=iterations, maxDepth=depth, seed=seed,
        predictionCol="_hard",
    )
    # GBTClassifier keeps the default names of its probability and raw columns.
    return PipelineModel([learner.fit(spread(flat_window(train).select("_x", label)))])


def spread(rows: DataFrame, most: int = TREE_ROWS) -> DataFrame:
    """``rows`` dealt out evenly where a task would have more than ``most``.

    A file split of windows is small while packed and may be ten times that once unpacked; splits
    of other files beside it do not make it smaller.
    """
    held = rows.groupBy(F.spark_partition_id().alias("_task")).count()
    total, largest = held.agg(F.sum("count"), F.max("count")).first()
    return rows if (largest or 0) <= most else rows.repartition(-(-total // most))


def score_trees(df: DataFrame, model: PipelineModel, out: str = "transformer_prob") -> DataFrame:
    """Add the YES probability of the fitted trees."""
    scored = model.transform(flat_window(df))
    return scored.withColumn(out, vector_to_array("probability")[1]).select(*df.columns, out)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


# --- models trained elsewhere -------------------------------------------------------


def score_external(
    df: DataFrame,
    scorer: Callable[[np.ndarray], np.ndarray],
    out: str = "external_prob",
    window: str = "window",
) -> DataFrame:
    """Add the probability a model trained elsewhere gives to each window.

    ``scorer`` maps an array (rows, steps, features) to (rows,). It is shipped once per
    task and called per Arrow batch; the plan is map-only.
    """
    kept = [c for c in df.columns if c != window]
    schema = T.StructType([*df.select(*kept).schema.fields, T.StructField(out, T.DoubleType())])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            steps = batch.column(window)
            cells = steps.flatten()
            values = cells.flatten().to_numpy(zero_copy_only=False).astype(float)
            # All windows have the same steps and features; other lengths fail to reshape.
            shape = len(batch), len(cells) // len(batch), -1
            found = np.asarray(scorer(values.reshape(shape)), dtype=float).ravel()
            own = [batch.column(c) for c in kept]
            yield pa.RecordBatch.from_arrays([*own, pa.array(found)], names=[*kept, out])

    return df.mapInArrow(score, schema)


# --- blend and report ---------------------------------------------------------------


def blend_members(df: DataFrame, weight=0.5, out: str = "ensemble_prob") -> DataFrame:
    return df.withColumn(out, blend(F.col("lstm_prob"), F.col("transformer_prob"), weight))


def accuracy(df: DataFrame, probs: Sequence[str], label: str = "label", keys: Sequence[str] = ()):
    """Share of rows whose probability is on the right side of one half, per model."""
    right = [
        F.avg(((F.col(p) >= 0.5).cast("int") == F.col(label).cast("int")).cast("double")).alias(
            f"accuracy_{p.removesuffix('_prob')}"
        )
        for p in probs
    ]
    return df.groupBy(*keys).agg(*right)


def backends() -> Column:
    """What stands behind each member, for the run's metadata."""
    return F.create_map(
        F.lit("lstm"), F.lit("logistic on window summaries"),
        F.lit("transformer"), F.lit("boosted trees on the window"),
    )


SUMMARY = summary_names(FEATURES)
