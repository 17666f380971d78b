"""Contiguous shards of equal bytes, cut by global prefix sums.

Rows are put in the order of their key, range-partitioned, and numbered. A partition is seen as
blocks of ``BLOCK`` rows; each block yields one row of totals, and running totals over the
blocks - first within a partition, then over partitions - say how many bytes and rows lie
before it. A row's own running sum is taken inside its block, so no task holds more than a
block, a partition's blocks, or one row per partition. Bytes are cut at equal targets: a row
belongs to the shard in which its middle byte lies.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from edgeframe.llm.common import staged, text_of

SHARDS = 16
#: Rows whose sums are taken together; a power of two.
BLOCK = 1 << 16


def _before(totals: DataFrame, within: str | None, order: str) -> DataFrame:
    """``totals`` with the sums of bytes and rows of what lies before, per ``within``."""
    window = Window.partitionBy(F.col(within) if within else F.lit(0)).orderBy(order)
    earlier = window.rowsBetween(Window.unboundedPreceding, -1)
    return totals.withColumns(
        {
            f"_{name}_before": F.coalesce(F.sum(f"_{name}").over(earlier), F.lit(0).cast("long"))
            for name in ("bytes", "rows")
        }
    )


def positioned(rows: DataFrame, size: str, block: int = BLOCK) -> DataFrame:
    """``rows`` (staged, with ``_place`` from ``monotonically_increasing_id``) with ``_start`` and
    ``_number``: bytes and rows before each, in the order of ``_place``."""
    placed = rows.withColumns(
        {"_part": F.shiftright("_place", 33), "_block": F.floor(F.col("_place") / block)}
    )
    blocks = placed.groupBy("_part", "_block").agg(
        F.sum(size).alias("_bytes"), F.count(F.lit(1)).alias("_rows")
    )
    in_part = _before(blocks, "_part", "_block")
    parts = blocks.groupBy("_part").agg(F.sum("_bytes").alias("_bytes"), F.sum("_rows").alias("_rows"))
    # One row per partition of the input: the only window over everything.
    over_all = _before(parts, None, "_part").select(
        "_part", F.col("_bytes_before").alias("_b"), F.col("_rows_before").alias("_r")
    )
    before = in_part.join(over_all, "_part").select(
        "_block",
        (F.col("_bytes_before") + F.col("_b")).alias("_bytes_before"),
        (F.col("_rows_before") + F.col("_r")).alias("_rows_before"),
    )
    inside = Window.partitionBy("_block").orderBy("_place").rowsBetween(Window.unboundedPreceding, 0)
    return (
        placed.withColumns({"_in": F.sum(size).over(inside), "_nr": F.row_number().over(inside)})
        .join(before, "_block")
        .withColumns(
            {
                "_start": F.col("_bytes_before") + F.col("_in") - F.col(size),
                "_number": F.col("_rows_before") + F.col("_nr") - 1,
            }
        )
        .drop("_part", "_block", "_in", "_nr", "_bytes_before", "_rows_before")
    )


def ordered(rows: DataFrame, key: str) -> DataFrame:
    """``rows`` staged in the order of ``key``, with ``_place``; equal keys are split freely."""
    numbered = rows.withColumn("_from", F.monotonically_increasing_id())
    partitions = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sorted_rows = numbered.repartitionByRange(partitions, key, "_from").sortWithinPartitions(key, "_from")
    return staged(sorted_rows.withColumn("_place", F.monotonically_increasing_id()).drop("_from"), "shard-rows")


def sharded(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    shards: int = SHARDS,
    carry: Sequence[str] = (),
    block: int = BLOCK,
) -> DataFrame:
    """Columns ``carry``, then ``doc_id``, ``size``, ``text_crc32``, ``shard`` and ``slot``.

    ``size`` is the UTF-8 length of the text plus one; a null text counts as empty. Rows are in
    the order of the key (null first), repeated rows side by side in the order they were read;
    slots count from 0 in each shard. An empty table gives no rows; a shard may stay empty if a
    row is larger than a share.
    """
    rows = docs.select(
        *[F.col(c) for c in carry],
        F.col(key).alias("doc_id"),
        (F.octet_length(text_of(text)) + 1).cast("long").alias("size"),
        F.crc32(text_of(text).cast("binary")).alias("text_crc32"),
    )
    placed = ordered(rows, "doc_id")
    whole = placed.agg(F.sum("size")).first()[0] or 1
    numbered = staged(
        positioned(placed, "size", block).withColumn(
            "shard", F.expr(f"int((_start * 2 + size) * {shards}L div {2 * whole}L)")
        ),
        "shard-numbers",
    )
    starts = numbered.groupBy("shard").agg(F.min("_number").alias("_first"))  # ``shards`` rows
    return numbered.join(starts, "shard").select(
        *carry, "doc_id", "size", "text_crc32", "shard", (F.col("_number") - F.col("_first")).alias("slot")
    )


def report(docs: DataFrame, key: str = "doc_id", text: str = "text", shards: int = SHARDS) -> DataFrame:
    """The shards under the law ``bytes``: sizes near equal, at most a row from the target."""
    return sharded(docs, key, text, shards).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def write_shards(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", shards: int = SHARDS) -> None:
    """``docs`` as Parquet under ``path``, one folder per shard, each written by several tasks."""
    as_is = F.struct(*docs.columns).alias("_row")
    rows = sharded(docs.select(as_is, F.col(key).alias("_key"), F.col(text).alias("_text")), "_key", "_text", shards, ["_row"])
    rows.select(*[F.col(f"_row.{c}").alias(c) for c in docs.columns], F.col("shard").alias("_shard")).write.partitionBy("_shard").parquet(path)
