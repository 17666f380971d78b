"""Exact top-k search by tiled matrix products.

Queries are taken in blocks of bounded size, each broadcast to the shards of the table (its
input partitions). A task multiplies the block with a tile of its shard at a time, selects the
best of each tile, and keeps one list per query; the lists of all tasks are merged in a tree,
``FAN`` lists at a time. Scores are integers, computed in floating point only where that is
exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from edgeframe.llm.common import staged

K = 5
#: Queries of a block, and vectors of a tile, at most.
BLOCK = 4096
TILE = 4096
#: Bytes of a broadcast block, at most; wide vectors make smaller blocks.
BLOCK_BYTES = 32 << 20
#: Lists merged at a time.
FAN = 32

_EXACT = 2.0**53


def quantised(vector: Column, steps: int = 256) -> Column:
    """floor(steps * x) of every component, as longs; null if any component is no finite number."""
    wide = F.transform(vector, lambda x: x.cast("double"))
    finite = F.forall(
        wide, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))
    )
    return F.when(finite, F.transform(wide, lambda x: F.floor(x * F.lit(float(steps)))))


def products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Inner products of integer rows, exact; beyond 64 bits they stop at the limits."""
    if not left.size or not right.size:
        return np.zeros((len(left), len(right)), np.int64)
    most = float(np.abs(left.astype(float)).max()) * float(np.abs(right.astype(float)).max())
    if most * left.shape[1] < _EXACT:
        return (left.astype(float) @ right.astype(float).T).astype(np.int64)
    exact = left.astype(object) @ right.astype(object).T
    limits = np.iinfo(np.int64)
    return np.clip(exact, limits.min, limits.max).astype(np.int64)


def best_of(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Per row, the ``k`` highest scores and their ids; ties to smaller ids.

    ``ids`` must ascend. A score and its place make one number, so that a partial selection
    settles ties too.
    """
    k = min(k, scores.shape[1])
    width = scores.shape[1]
    top = int(np.abs(scores).max()) if scores.size else 0
    if top < (1 << 62) // max(1, width):
        mark = scores * width + (width - 1 - np.arange(width))
        some = np.argpartition(mark, width - k, axis=1)[:, width - k :]
        order = np.argsort(-np.take_along_axis(mark, some, 1), axis=1)
        some = np.take_along_axis(some, order, 1)
    else:
        some = np.argsort(-scores.astype(object), axis=1, kind="stable")[:, :k]
    return np.take_along_axis(scores, some, 1), ids[some]


class _Lists:
    """Top lists of the queries of a block, over the tiles a task has seen."""

    NONE = np.iinfo(np.int64).min

    def __init__(self, queries: np.ndarray, names: np.ndarray, k: int) -> None:
        self.queries, self.names, self.k = queries, names, k
        self.scores = np.empty((len(names), 0), np.int64)
        self.ids = np.empty((len(names), 0), np.int64)
        self.held = np.empty((len(names), 0), bool)

    def add(self, vectors: np.ndarray, ids: np.ndarray) -> None:
        order = np.argsort(ids, kind="stable")
        vectors, ids = vectors[order], ids[order]
        scores = products(self.queries, vectors)
        # One more than asked for each copy of the query's own id, which is then left out.
        low = np.searchsorted(ids, self.names)
        own = int((np.searchsorted(ids, self.names, "right") - low).max(initial=0))
        found, names = best_of(scores, ids, self.k + own)
        scores = np.hstack([self.scores, found])
        ids = np.hstack([self.ids, names])
        held = np.hstack([self.held, names != self.names[:, None]])
        order = np.lexsort((ids, -scores, ~held), axis=1)[:, : self.k]
        self.scores, self.ids, self.held = (np.take_along_axis(x, order, 1) for x in (scores, ids, held))

    def rows(self) -> pa.RecordBatch:
        at, place = np.nonzero(self.held)
        return pa.RecordBatch.from_arrays(
            [pa.array(self.names[at]), pa.array(self.ids[at, place]), pa.array(self.scores[at, place])],
            names=["query_id", "vec_id", "score"],
        )


def _matrix(column: pa.Array, dimension: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dimension)


def _searched(vectors: DataFrame, block: np.ndarray, names: np.ndarray, k: int, tile: int) -> DataFrame:
    """Top lists of one block per task: (``query_id``, ``vec_id``, ``score``, ``_list``)."""
    shared = vectors.sparkSession.sparkContext.broadcast((block, names))
    dimension = block.shape[1]

    def run(batches) -> Iterator[pa.RecordBatch]:
        lists = _Lists(*shared.value, k)
        for batch in batches:
            for at in range(0, len(batch), tile):
                part = batch.slice(at, tile)
                if dimension:
                    rows = _matrix(part.column("_vector"), dimension)
                else:
                    rows = np.empty((len(part), 0), np.int64)
                lists.add(rows, part.column("vec_id").to_numpy(zero_copy_only=False))
        yield lists.rows()

    same = vectors.where(F.size("_vector") == dimension).select("vec_id", "_vector")
    return same.mapInArrow(run, "query_id long, vec_id long, score long").withColumn(
        "_list", F.spark_partition_id().cast("long")
    )


def _merged(lists: DataFrame, by: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), "vec_id")
    return lists.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _block_of(blocks: int) -> Column:
    # Over key and vector, so that many vectors under one key are spread too.
    return F.pmod(F.xxhash64("vec_id", "_vector"), F.lit(blocks))


def _queries(chosen: DataFrame, wanted: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Blocks of distinct queries, by dimension; each is small enough to broadcast."""
    sizes = chosen.groupBy(F.size("_vector").alias("n")).count().orderBy("n").collect()  # one per dimension
    for dimension, count in sizes:
        rows = max(1, min(wanted, BLOCK_BYTES // (8 * max(1, dimension))))
        blocks = -(-count // rows)
        own = chosen.where(F.size("_vector") == dimension)
        for number in range(blocks):
            part = own if blocks == 1 else own.where(_block_of(blocks) == number)
            found = part.orderBy("vec_id").collect()
            if found:
                vectors = np.array([r["_vector"] for r in found], np.int64).reshape(len(found), dimension)
                yield vectors, np.array([r["vec_id"] for r in found], np.int64)


def search(
    vectors: DataFrame,
    is_query: Column,
    k: int = K,
    key: str = "vec_id",
    vector: str = "embedding",
    block: int = BLOCK,
    tile: int = TILE,
) -> DataFrame:
    """(``query_id``, ``rank``, ``vec_id``, ``score``): the ``k`` best other rows of each query.

    ``is_query`` picks the queries. Vectors that are null or hold a null or non-finite component
    take no part, nor do rows without a key. Vectors are compared with those of the same
    dimension. Repeated rows are candidates once per row and a query once; rows with the key of
    the query are its own and left out; different vectors under one query key share its list.
    Fewer candidates give fewer ranks, an empty table none.
    """
    numbers = vectors.withColumn("_query", is_query).select(
        F.col(key).cast("long").alias("vec_id"), quantised(F.col(vector)).alias("_vector"), "_query"
    )
    usable = numbers.where(F.col("vec_id").isNotNull() & F.col("_vector").isNotNull())
    chosen = usable.where("_query").select("vec_id", "_vector").dropDuplicates(["vec_id", "_vector"])
    found = None
    for number, (block_rows, names) in enumerate(_queries(chosen, block)):
        lists = staged(_searched(usable, block_rows, names, k, tile), f"topk-lists-{number}")
        many = lists.agg(F.max("_list")).first()[0]
        while many is not None and many >= FAN:
            lists = _level(lists, k)
            many //= FAN
        found = lists if found is None else found.unionByName(lists)
    if found is None:
        empty = "query_id long, rank int, vec_id long, score long"
        return vectors.sparkSession.createDataFrame([], empty)
    return _merged(found, ["query_id"], k).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"
    )


def _level(lists: DataFrame, k: int) -> DataFrame:
    """One level of the tree: ``FAN`` lists of a query become one."""
    grouped = lists.withColumn("_list", F.floor(F.col("_list") / FAN))
    return _merged(grouped, ["query_id", "_list"], k).drop("rank")
