"""Whitening of embeddings from an exact scatter matrix of bit planes.

Vectors become integers, and each distinct one is counted once. A task takes its vectors a block
at a time, shifts every dimension to start at zero, and packs each bit of a dimension across the
rows of the block into words: one bit plane per dimension and bit. The sum of products of two
dimensions is then the sum of popcounts of planes ANDed pairwise, weighted by powers of two; the
shift is undone by the sums of the dimensions, which a further dimension of ones yields. All of
it is integers of any size, so tasks and blocks add up to the same matrix in any order.

Only the matrix, whose size is given by the number of dimensions, goes to the driver. There it
is centred as integers, n * sum(x_i * x_j) - S_i * S_j, divided once per entry, and decomposed.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from edgeframe.llm.common import staged
from edgeframe.llm.topk import quantised

#: Leading components that are returned.
COMPONENTS = 4
#: Rows whose planes are packed together; a multiple of 64.
ROWS = 8192
#: Bytes of ANDed planes held at a time.
TILE_BYTES = 8 << 20
#: Dimensions of a vector, at most: the matrix of so many is held by a task and by the driver.
WIDEST = 4096

_LIMB = 40  # bits of the parts in which long integers travel
_INT64 = (1 << 63) - 1


def bit_planes(values: np.ndarray) -> np.ndarray:
    """Planes (bit, dimension, word) of rows of unsigned numbers; rows are filled up with zeros."""
    bits = int(values.max(initial=0)).bit_length()
    rows, dimension = values.shape
    planes = np.zeros((bits, dimension, -(-rows // 64) * 8), np.uint8)
    for bit in range(bits):
        plane = np.packbits(((values >> np.uint64(bit)) & np.uint64(1)).astype(np.uint8).T, axis=1)
        planes[bit, :, : plane.shape[1]] = plane
    return planes.view(np.uint64)


def plane_products(planes: np.ndarray) -> np.ndarray:
    """Sums of products of all pairs of dimensions, as Python integers."""
    bits, dimension, words = planes.shape
    total = np.zeros((dimension, dimension), object)
    step = max(1, TILE_BYTES // max(1, 8 * dimension * words))
    for a in range(bits):
        for b in range(a, bits):
            counts = np.empty((dimension, dimension), np.int64)
            for at in range(0, dimension, step):
                both = planes[a, at : at + step, None, :] & planes[b, None, :, :]
                counts[at : at + step] = np.bitwise_count(both).sum(2, dtype=np.int64)
            if a != b:
                counts = counts + counts.T
            total += counts.astype(object) * (1 << (a + b))
    return total


def scatter(rows: np.ndarray) -> np.ndarray:
    """Sums of products of the columns of ``rows`` (longs) and of a last column of ones."""
    low = rows.min(0)
    shifted = rows.astype(np.uint64) - low.astype(np.uint64)  # right even beyond 63 bits
    ones = np.ones((len(rows), 1), np.uint64)
    products = plane_products(bit_planes(np.hstack([shifted, ones])))
    shift = np.append(low.astype(object), 0)
    sums = products[:, -1]
    return products + np.outer(shift, sums) + np.outer(sums, shift) + len(rows) * np.outer(shift, shift)


def _limbs(total: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
    """(row, column, limb, part) of the upper triangle; the last part of a number has its sign."""
    for i, j in zip(*np.triu_indices(len(total))):
        value, limb = int(total[i, j]), 0
        while not -(1 << _LIMB) < value < 1 << _LIMB:
            yield int(i), int(j), limb, value & ((1 << _LIMB) - 1)
            value, limb = value >> _LIMB, limb + 1
        yield int(i), int(j), limb, value


_PARTS = "_size int, _i int, _j int, _limb int, _part long"


def _scatters(batches) -> Iterator[pa.RecordBatch]:
    """The scatter matrices of a task's vectors, one per dimension, in parts."""
    held: dict[int, np.ndarray] = {}

    def parts() -> Iterator[pa.RecordBatch]:
        for size, total in held.items():
            i, j, limb, part = zip(*_limbs(total))
            columns = [pa.array(c, t) for c, t in ((i, pa.int32()), (j, pa.int32()), (limb, pa.int32()), (part, pa.int64()))]
            names = ["_size", "_i", "_j", "_limb", "_part"]
            yield pa.RecordBatch.from_arrays([pa.array([size] * len(i), pa.int32()), *columns], names=names)
        held.clear()

    for batch in batches:
        for size, rows in _by_size(batch.column("_vector")):
            for at in range(0, len(rows), ROWS):
                found = scatter(rows[at : at + ROWS])
                held[size] = held[size] + found if size in held else found
        if sum(map(np.size, held.values())) > 2 * (WIDEST + 1) ** 2:
            yield from parts()  # vectors of very many lengths
    yield from parts()


def _by_size(vectors: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    sizes = vectors.value_lengths().to_numpy(zero_copy_only=False)
    for size in np.unique(sizes):
        some = vectors.filter(pa.array(sizes == size))
        yield int(size), some.flatten().to_numpy(zero_copy_only=False).reshape(len(some), size)


@dataclass(frozen=True)
class Fit:
    """Exact count and sums, and the leading components (rows) with their eigenvalues."""

    n: int
    sums: tuple[int, ...]
    components: np.ndarray
    values: np.ndarray
    trace: float

    def centred(self, rows: np.ndarray) -> np.ndarray:
        """n * x - S, exact."""
        most = max([1, *map(abs, self.sums)])
        if self.n * float(np.abs(rows.astype(float)).max(initial=0)) + most < 2.0**62:
            return rows * self.n - np.array(self.sums, np.int64)
        return rows.astype(object) * self.n - np.array(self.sums, object)

    def whitened(self, centred: np.ndarray) -> np.ndarray:
        return (centred / self.n).astype(float) @ (self.components / np.sqrt(self.values)[:, None]).T


def decomposed(total: np.ndarray, most: int) -> Fit:
    """The fit of a scatter matrix with a last column of ones.

    Components whose eigenvalue is zero to double precision are left out.
    """
    n = int(total[-1, -1])
    sums = tuple(int(s) for s in total[:-1, -1])
    size = len(sums)
    centred = n * total[:-1, :-1] - np.outer(np.array(sums, object), np.array(sums, object))
    covariance = np.array([[int(v) / (n * n) for v in row] for row in centred], float).reshape(size, size)
    values, vectors = np.linalg.eigh(covariance)
    order = np.argsort(-values, kind="stable")[:most]
    order = order[values[order] > max(values, default=0.0) * size * np.finfo(float).eps]
    return Fit(n, sums, vectors[:, order].T.copy(), values[order], float(np.trace(covariance)))


def fits(numbers: DataFrame, components: int = COMPONENTS, vector: str = "_vector") -> dict[int, Fit]:
    """A fit per vector length over rows of distinct long vectors."""
    longest = numbers.agg(F.max(F.size(vector))).first()[0] or 0
    if longest > WIDEST:
        raise ValueError(f"vectors of more than {WIDEST} dimensions")
    parts = numbers.select(F.col(vector).alias("_vector")).mapInArrow(_scatters, _PARTS)
    rows = parts.groupBy("_size", "_i", "_j", "_limb").agg(F.sum("_part").alias("_part")).collect()
    totals: dict[int, np.ndarray] = {}
    for size, i, j, limb, part in rows:
        total = totals.setdefault(size, np.zeros((size + 1, size + 1), object))
        total[i, j] += part << (_LIMB * limb)
        if i != j:
            total[j, i] = total[i, j]
    return {size: decomposed(total, components) for size, total in sorted(totals.items())}


def _identity_error(fit_rows: DataFrame, count: int) -> float:
    """The largest entry of the covariance of ``_white`` minus the identity."""
    pairs = [(i, j) for i in range(count) for j in range(i, count)]
    found = fit_rows.agg(
        *[F.covar_pop(F.col("_white")[i], F.col("_white")[j]).alias(f"c{i}_{j}") for i, j in pairs]
    ).first()
    return max((abs(c - (i == j)) for (i, j), c in zip(pairs, found)), default=0.0)


def _projected(rows: DataFrame, fit: Fit) -> DataFrame:
    """``rows`` with ``_white`` (array) and ``deviation`` instead of ``_vector``."""
    kept = [c for c in rows.columns if c != "_vector"]
    schema = T.StructType([rows.schema[c] for c in kept]).add("deviation", "long").add("_white", T.ArrayType(T.DoubleType()))

    def run(batches):
        width = len(fit.values)
        for batch in batches:
            for at in range(0, len(batch), ROWS):
                part = batch.slice(at, ROWS)
                vectors = part.column("_vector").flatten().to_numpy(zero_copy_only=False)
                centred = fit.centred(vectors.reshape(len(part), len(fit.sums)))
                if float(np.abs(centred.astype(float)).max(initial=0)) ** 2 * max(1, len(fit.sums)) < 2.0**62:
                    deviation = (centred * centred).sum(1).astype(np.int64)
                else:
                    wide = centred.astype(object)
                    deviation = [min(int(s), _INT64) for s in (wide * wide).sum(1)]
                white = fit.whitened(centred)
                lists = pa.ListArray.from_arrays(
                    pa.array(np.arange(len(part) + 1) * width, pa.int32()), pa.array(white.ravel(), pa.float64())
                )
                own = [part.column(c) for c in kept]
                yield pa.RecordBatch.from_arrays([*own, pa.array(deviation, pa.int64()), lists], names=schema.names)

    return rows.mapInArrow(run, schema)


def whitened(
    vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS
) -> DataFrame:
    """(``vec_id``, ``component``, ``n``, ``deviation``, ``whitened``, ``explained``, ``identity_error``).

    One row per vector and leading component. Vectors that are null or hold a null or non-finite
    component are left out; rows with a null key and repeated rows keep their rows, but equal
    vectors count once in the fit. Vectors of another length have a fit of their own. Components
    without variance have no whitened value and no row, so a single distinct vector gives no
    rows, like an empty table; nor do empty vectors. Numbers beyond 64 bits stop at the limits,
    ``deviation`` too.
    """
    numbers = vectors.select(F.col(key).alias("vec_id"), quantised(F.col(vector)).alias("_vector"))
    rows = staged(numbers.where(F.col("_vector").isNotNull() & (F.size("_vector") > 0)), "whiten-rows")
    distinct = staged(rows.select("_vector").dropDuplicates(["_vector"]), "whiten-fit")
    result = None
    for size, fit in fits(distinct, components).items():
        count = len(fit.values)
        if not count:
            continue
        error = _identity_error(_projected(distinct.where(F.size("_vector") == size), fit), count)
        explained = F.array(*[F.lit(float(e / fit.trace)) for e in fit.values])
        found = _projected(rows.where(F.size("_vector") == size), fit).select(
            "vec_id", "deviation", F.posexplode("_white").alias("_at", "whitened")
        )
        found = found.select(
            "vec_id",
            (F.col("_at") + 1).alias("component"),
            F.lit(fit.n).cast("long").alias("n"),
            "deviation",
            "whitened",
            F.element_at(explained, F.col("_at") + 1).alias("explained"),
            F.lit(error).alias("identity_error"),
        )
        result = found if result is None else result.unionByName(found)
    if result is None:
        empty = "component int, n long, deviation long, whitened double, explained double, identity_error double"
        return rows.where("false").select(
            "vec_id", *[F.lit(None).cast(c.split()[1]).alias(c.split()[0]) for c in empty.split(", ")]
        )
    return result
