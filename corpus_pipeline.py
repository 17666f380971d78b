"""A corpus pipeline over ``documents``: each stage is one of the operators of ``edgeframe.llm``.

Toxic texts go, then copies, then all but one of each group of near copies; secrets are masked
in the texts, and what is left is packed into token sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from edgeframe.llm import exact, minhash, packing, secrets, toxicity
from edgeframe.llm.common import table
from edgeframe.llm.queries import vocabulary_path
from edgeframe.session import ship
from edgeframe.storage import scratch


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score stays below the threshold."""
    return toxicity.accepted(docs, table(spark, sf_dir, "labels"))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact.deduplicated(docs)


def minhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return minhash.deduplicated(docs)


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets masked."""
    return secrets.redacted(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their place in a sequence."""
    return packing.pack(docs, vocabulary_path())


STAGES = [
    ("toxicity", toxicity_stage),
    ("exact", exact_stage),
    ("minhash", minhash_stage),
    ("secrets", secrets_stage),
    ("packing", packing_stage),
]

#: SQL cannot express the stages; the tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's result is written and read again."""
    ship(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
