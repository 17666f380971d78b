"""Helpers shared by the operators: staged tables, tables of the test folders, id handling."""

from __future__ import annotations

from collections.abc import Callable
from typing import TypeVar

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from edgeframe.storage import scratch

State = TypeVar("State")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


#: Bytes of a batch that goes to a Python worker while a table is staged.
BATCH_BYTES = "8m"
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read again: lineage ends there.

    Row numbers taken before (``monotonically_increasing_id``) are fixed by it. Texts and sets
    may be large, so Python workers get smaller batches than by default meanwhile.
    """
    spark = df.sparkSession
    path = scratch(spark, name)
    before = spark.conf.get(_BATCH, None)
    spark.conf.set(_BATCH, BATCH_BYTES)
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(_BATCH) if before is None else spark.conf.set(_BATCH, before)
    return spark.read.schema(df.schema).parquet(path)


def text_of(column: str = "text") -> Column:
    """The text; null counts as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def free_name(df: DataFrame, wanted: str) -> str:
    """A column name that ``df`` does not have, whatever the case."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted = "_" + wanted
    return wanted


_held: dict[object, object] = {}


def kept_in_worker(key: object, make: Callable[[], State]) -> State:
    """What a Python worker keeps from task to task: one thing at a time.

    Workers outlive the stages that use them. Tables of remembered words of several operators
    would add up there, so asking for another ``key`` lets go of what was held.
    """
    if key not in _held:
        let_go()
        _held[key] = make()
    return _held[key]


def let_go() -> None:
    """Drop what this worker keeps, and give memory back that nothing uses."""
    _held.clear()
    pa.default_memory_pool().release_unused()
