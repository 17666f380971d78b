"""Exact deduplication: 128-bit hashes group, bytes decide. DataFrame functions only.

A narrow table holds hash, digest and length of every row. Equal texts are reduced to one per
input task before they are shuffled, and compared byte by byte as grouping keys: a hash that
two different texts share is told apart by the digest, so a collision cannot join them. Groups
are found by a partial aggregation and joined back to the narrow rows, whose large groups Spark
splits.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from edgeframe.llm.common import free_name, staged, text_of

BLANKS = r"[\x20\x09-\x0D]+"


def normalised(text: Column) -> Column:
    """The text without ASCII white space."""
    return F.regexp_replace(text, BLANKS, "")


def md5_128(text: Column) -> Column:
    return F.unhex(F.md5(text))


def grouped(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    carry: Sequence[str] = (),
    fingerprint: Callable[[Column], Column] = md5_128,
) -> DataFrame:
    """Every row with the row that stays for it.

    Columns: ``carry``, then ``_row``, ``_doc_id``, ``_keep_id``, ``_group_size``, ``_kept`` and
    ``_sha256``. Texts are equal if they are so without white space; null counts as empty. The
    row with the most code points stays, then the smallest key (a null key last), then the first
    row, so exactly one row of a group stays even among repeated rows. An empty table gives none.
    """
    body = normalised(text_of(text))
    keys = staged(
        docs.select(
            *[F.col(c) for c in carry],
            F.monotonically_increasing_id().alias("_row"),
            F.col(key).alias("_doc_id"),
            fingerprint(body).alias("_hash"),
            F.sha2(body, 256).alias("_sha256"),
            F.length(text_of(text)).alias("_size"),
        ),
        "exact-keys",
    )
    distinct = docs.select(fingerprint(body).alias("_hash"), body.alias("_body")).distinct()
    shared = distinct.groupBy("_hash").agg(F.count(F.lit(1)).alias("_texts")).where("_texts > 1")
    collided = staged(shared.select("_hash", F.lit(True).alias("_collided")), "exact-collided")
    named = keys.join(collided, "_hash", "left").withColumn(
        "_text", F.when(F.col("_collided"), F.col("_sha256")).otherwise(F.lit(""))
    )
    first = F.struct(
        (-F.col("_size")).alias("size"),
        F.col("_doc_id").isNull().alias("unnamed"),
        F.col("_doc_id").alias("id"),
        F.col("_row").alias("row"),
    )
    groups = (
        named.groupBy("_hash", "_text")
        .agg(F.count(F.lit(1)).alias("_n"), F.min(first).alias("_first"))
        .where("_n > 1")
        .select(
            "_hash",
            "_text",
            "_n",
            F.col("_first.id").alias("_first_id"),
            F.col("_first.row").alias("_first_row"),
        )
    )
    # Read from a table, the groups have no partitioning of their own: Spark may then split the
    # rows of a large group, as both sides of the join are shuffled for it.
    groups = staged(groups, "exact-groups")
    joined = named.join(groups, ["_hash", "_text"], "left")
    alone = F.col("_n").isNull()
    return joined.select(
        *[F.col(c) for c in carry],
        "_row",
        "_doc_id",
        F.when(alone, F.col("_doc_id")).otherwise(F.col("_first_id")).alias("_keep_id"),
        F.coalesce("_n", F.lit(1).cast("long")).alias("_group_size"),
        (alone | (F.col("_row") == F.col("_first_row"))).alias("_kept"),
        "_sha256",
    )


def report(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One row per document: ``doc_id``, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``."""
    names = ["doc_id", "keep_id", "group_size", "kept", "sha256"]
    rows = grouped(docs, key, text, **options).select(*[F.col("_" + n).alias(n) for n in names])
    return rows.withColumnRenamed("sha256", "text_sha256")


def deduplicated(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` with one row of each group of equal texts; columns as they were."""
    row = free_name(docs, "_place")
    placed = staged(docs.withColumn(row, F.monotonically_increasing_id()), "exact-docs")
    rows = grouped(placed, key, text, carry=[row], **options)
    gone = rows.where(~F.col("_kept")).select(row)
    return placed.join(gone, row, "left_anti").select(*docs.columns)
