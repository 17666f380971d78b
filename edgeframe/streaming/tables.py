"""Keyed tables kept up to date by a stream: latest values, capped lists, sums.

A table is cut into hash buckets of its keys. A batch writes one run, the reduced rows of the
buckets it touches, and no other bucket. A manifest per batch lists the runs each bucket consists
of; a reader reduces them. As soon as a bucket ends in ``FAN`` runs of one level, they are merged
into a run of the next level, so a row is rewritten a logarithmic number of times and a bucket has
a logarithmic number of runs.

Batch n starts from the manifest of batch n - 1 and writes runs and a manifest of its own, so a
batch that is run again finds its input untouched and gives the same result. What neither of the
newest two manifests names is removed. A path belongs to one checkpoint.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Sequence
from dataclasses import asdict, dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from edgeframe.defaults import SIGNALS_KEPT
from edgeframe.operators.blocks import newest
from edgeframe.storage import children, remove

BUCKETS = 32
FAN = 4
_BUCKET = "_bucket"
_MANIFEST = "bucket int, at int, run string, level int, about string"


@dataclass(frozen=True)
class Rule:
    """What stays of the rows of a key, whatever parts they come in.

    The newest ``keep`` rows in ``order``; or, with ``keep`` 1, one row with the newest values of
    the other columns and the sums, maxima and minima of those named.
    """

    keys: Sequence[str]
    order: Sequence[str]
    keep: int = 1
    total: Sequence[str] = ()
    high: Sequence[str] = ()
    low: Sequence[str] = ()

    def reduce(self, df: DataFrame) -> DataFrame:
        if self.keep > 1:
            return newest(df, self.keys, self.order, self.keep).drop("_rank")
        merged = {c: f for f, cs in ((F.sum, self.total), (F.max, self.high), (F.min, self.low)) for c in cs}
        rest = [c for c in df.columns if c not in self.keys and c not in merged]
        found = [f(c).alias(c) for c, f in merged.items()]
        if rest:
            found.append(F.max_by(F.struct(*rest), F.struct(*self.order)).alias("_newest"))
        out = df.groupBy(*self.keys).agg(*found)
        return out.select(
            *[F.col(f"_newest.{c}").alias(c) if c in rest else F.col(c) for c in df.columns]
        )


class KeyedTable:
    """A table of ``rule`` in hash buckets of ``by``, some or all of the rule's keys."""

    def __init__(
        self, path: str, rule: Rule, by: Sequence[str] | None = None, buckets: int = BUCKETS
    ):
        self.path, self.rule, self.buckets = path, rule, buckets
        self.by = list(rule.keys if by is None else by)

    @classmethod
    def stored(cls, spark: SparkSession, path: str) -> KeyedTable:
        """The table at ``path`` as its newest manifest describes it."""
        about = _manifest(spark, path, _newest(spark, path))[0]
        return cls(path, Rule(**about["rule"]), about["by"], about["buckets"])

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.by), F.lit(self.buckets)).cast("int")

    def touched(self, batch: DataFrame) -> list[int]:
        """The buckets of a batch; never more than the table has."""
        return [r[0] for r in batch.select(self.bucket()).distinct().collect()]

    def _about(self, schema: T.StructType) -> dict:
        rule = {k: list(v) if isinstance(v, (list, tuple)) else v for k, v in asdict(self.rule).items()}
        return {"rule": rule, "by": self.by, "buckets": self.buckets, "schema": schema.jsonValue()}

    def _known(self, spark: SparkSession, batch_id: int) -> tuple[dict | None, dict]:
        """The manifest that the batch before ``batch_id`` left; nothing before the first batch.

        A table that is gone or older than that is an error: going on would forget its rows.
        """
        if batch_id == 0:
            return None, {}
        about, runs = _manifest(spark, self.path, batch_id - 1)
        if (about["by"], about["buckets"]) != (self.by, self.buckets):
            raise ValueError(f"the table under {self.path} has other buckets")
        return about, runs

    def _rows(
        self, spark: SparkSession, about: dict, runs: dict, buckets: Iterable[int] | None = None
    ) -> DataFrame:
        wanted = runs if buckets is None else set(buckets) & set(runs)
        folders = [f"{self.path}/rows/{run}/{_BUCKET}={b}" for b in sorted(wanted) for run, _ in runs[b]]
        schema = T.StructType.fromJson(about["schema"])
        if not folders:
            return spark.createDataFrame([], schema)
        return self.rule.reduce(spark.read.schema(schema).parquet(*folders))

    def previous(
        self, spark: SparkSession, batch_id: int, buckets: Iterable[int] | None = None
    ) -> DataFrame | None:
        """The table, or some of its buckets, before ``batch_id``; None before the first batch."""
        about, runs = self._known(spark, batch_id)
        return None if about is None else self._rows(spark, about, runs, buckets)

    def current(self, spark: SparkSession) -> DataFrame:
        """The table as the newest finished batch left it."""
        return self._rows(spark, *_manifest(spark, self.path, _newest(spark, self.path)))

    def _write(self, df: DataFrame, run: str) -> None:
        # Split and joined by size: one task does not write all buckets, nor many tasks each.
        rows = self.rule.reduce(df).withColumn(_BUCKET, self.bucket()).hint("rebalance", _BUCKET)
        rows.write.mode("overwrite").partitionBy(_BUCKET).parquet(f"{self.path}/rows/{run}")

    def _written(self, spark: SparkSession, run: str) -> list[int]:
        names = children(spark, f"{self.path}/rows/{run}")
        return [int(n.split("=")[1]) for n in names if n.startswith(f"{_BUCKET}=")]

    def update(self, rows: DataFrame, batch_id: int) -> None:
        """Add a batch's rows; only the buckets of its keys are written."""
        spark = rows.sparkSession
        about, runs = self._known(spark, batch_id)
        about = about or self._about(rows.schema)
        run = f"batch-{batch_id}"
        self._write(rows, run)
        now = {b: list(r) for b, r in runs.items()}
        for b in self._written(spark, run):
            now.setdefault(b, []).append((run, 0))
        full = {b: n for b, r in now.items() if (n := _full(r))[0]}
        if full:
            merged = f"merged-{batch_id}"
            tails = {b: now[b][-n:] for b, (n, _) in full.items()}
            self._write(self._rows(spark, about, tails), merged)
            for b, (n, level) in full.items():
                now[b][-n:] = [(merged, level)]
        lines = [(-1, 0, str(batch_id), 0, json.dumps(about))] + [
            (b, i, name, level, None) for b, r in now.items() for i, (name, level) in enumerate(r)
        ]
        manifest = spark.createDataFrame(lines, _MANIFEST).coalesce(1)
        manifest.write.mode("overwrite").parquet(f"{self.path}/manifest/{batch_id}")
        self._clean(spark, batch_id, [now, runs])

    def _clean(self, spark: SparkSession, batch_id: int, manifests: list[dict]) -> None:
        """Remove what the newest two manifests do not name; listings are as short as they are."""
        named = {(run, b) for m in manifests for b, r in m.items() for run, _ in r}
        for run in children(spark, f"{self.path}/rows"):
            held = self._written(spark, run)
            stale = [b for b in held if (run, b) not in named]
            if len(stale) == len(held):
                remove(spark, f"{self.path}/rows/{run}")
            else:
                for b in stale:
                    remove(spark, f"{self.path}/rows/{run}/{_BUCKET}={b}")
        for name in children(spark, f"{self.path}/manifest"):
            if int(name) < batch_id - 1:
                remove(spark, f"{self.path}/manifest/{name}")


def _full(runs: list[tuple[str, int]]) -> tuple[int, int]:
    """How many of the last runs are to be merged, and the level of the result; (0, 0) for none."""
    taken, level = 0, 0
    while len(runs) - taken >= FAN - (taken > 0):
        # What has been taken counts as one run of its level.
        more = FAN - (taken > 0)
        tail = runs[len(runs) - taken - more : len(runs) - taken]
        if any(at != level for _, at in tail):
            break
        taken, level = taken + more, level + 1
    return taken, level


def _newest(spark: SparkSession, path: str) -> int:
    """The newest batch with a whole manifest."""
    folder = f"{path}/manifest"
    done = [int(n) for n in children(spark, folder) if "_SUCCESS" in children(spark, f"{folder}/{n}")]
    if not done:
        raise ValueError(f"there is no table under {path}")
    return max(done)


def _manifest(spark: SparkSession, path: str, batch_id: int) -> tuple[dict, dict]:
    """(what the table is, runs of each bucket, oldest first) after ``batch_id``.

    At most one line per bucket and run.
    """
    try:
        lines = spark.read.schema(_MANIFEST).parquet(f"{path}/manifest/{batch_id}").collect()
    except AnalysisException:
        lines = []
    about = [json.loads(r.about) for r in lines if r.bucket == -1 and r.run == str(batch_id)]
    if not about:
        raise ValueError(f"the table of batch {batch_id} is missing under {path}")
    runs: dict[int, list[tuple[str, int]]] = {}
    for r in sorted((r for r in lines if r.bucket >= 0), key=lambda r: (r.bucket, r["at"])):
        runs.setdefault(r.bucket, []).append((r.run, r.level))
    return about[0], runs


def current(spark: SparkSession, path: str) -> DataFrame:
    """The table at ``path`` as the newest finished batch left it."""
    return KeyedTable.stored(spark, path).current(spark)


def latest_sink(
    path: str, keys: Sequence[str], order: Sequence[str]
) -> Callable[[DataFrame, int], None]:
    """For ``foreachBatch``: keep the newest row of each key."""
    return KeyedTable(path, Rule(keys, order)).update


def capped_sink(
    path: str, keys: Sequence[str], order: Sequence[str], n: int = SIGNALS_KEPT
) -> Callable[[DataFrame, int], None]:
    """For ``foreachBatch``: keep the newest ``n`` rows of each key."""
    return KeyedTable(path, Rule(keys, order, n)).update
