"""Shared scratch space and reliable checkpoints."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a temporary one only in local mode."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    folder = tempfile.mkdtemp(prefix="edgeframe-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def scratch(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other run uses."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """``df`` written out reliably, so that its lineage ends here and survives lost executors."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint(eager=True)


def staged(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """``df`` written once to the shared folder, or to ``path``, and read again."""
    path = path or scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _files(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if it is not there."""
    files, place = _files(spark, path)
    if not files.exists(place):
        return []
    return [status.getPath().getName() for status in files.listStatus(place)]


def remove(spark: SparkSession, path: str) -> None:
    """Remove a file or folder of ours."""
    files, place = _files(spark, path)
    files.delete(place, True)
