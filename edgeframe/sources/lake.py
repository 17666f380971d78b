"""The feature lake and the run's other Parquet tables."""

from __future__ import annotations

import time

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from edgeframe import schemas
from edgeframe.defaults import MIN_LAKE_ROWS


def write_lake(features: DataFrame, path: str, replace: str = "all") -> dict:
    """Write the lake partitioned by year; return the counts of the ingest summary.

    The rebalance hint groups rows by year and lets Spark split a large year over several
    tasks and files. Rows are counted while they are written, not by a second pass.
    ``replace="years"`` overwrites only the years present in ``features``.
    """
    seen = Observation()
    mode = {"all": "static", "years": "dynamic"}[replace]
    (
        features.observe(
            seen, F.count(F.lit(1)).alias("rows"), F.max("date").alias("last_date")
        )
        .hint("rebalance", F.col("year"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", mode)
        .partitionBy("year")
        .parquet(path)
    )
    return seen.get


def read_lake(
    spark: SparkSession,
    path: str,
    years: tuple[int, int] | None = None,
    columns: list[str] | None = None,
) -> DataFrame:
    """The lake, limited to a range of years (partition pruning) and to columns."""
    lake = spark.read.schema(schemas.LAKE).parquet(path)
    if years:
        lake = lake.where(F.col("year").between(*years))
    return lake.select(*columns) if columns else lake


def lake_ready(spark: SparkSession, path: str, min_rows: int = MIN_LAKE_ROWS) -> bool:
    """True if a lake with more than ``min_rows`` rows exists; reads no more than needed."""
    try:
        return spark.read.parquet(path).limit(min_rows + 1).count() > min_rows
    except AnalysisException:
        return False


def ensure_lake(spark: SparkSession, path: str, build, min_rows: int = MIN_LAKE_ROWS) -> DataFrame:
    """The lake at ``path``, first written from ``build()`` if it is missing or too small."""
    if not lake_ready(spark, path, min_rows):
        write_lake(build(), path)
    return read_lake(spark, path)


def log_status(spark: SparkSession, path: str, stage: str, detail: str = "") -> bool:
    """Append one status record; a failing log never fails the job."""
    try:
        record = spark.createDataFrame([(stage, detail, time.time())], schemas.STATUS)
        record.coalesce(1).write.mode("append").parquet(path)
        return True
    except Exception:
        return False


def latest_status(spark: SparkSession, path: str) -> DataFrame:
    log = spark.read.schema(schemas.STATUS).parquet(path)
    return log.agg(F.max_by(F.struct("stage", "detail", "ts"), "ts").alias("s")).select("s.*")


def save_backtest(metrics: DataFrame, equity: DataFrame, best: DataFrame, path: str) -> None:
    """Write metrics joined with the run's parameters (one row per market) and the equity."""
    metrics.join(best, "market", "left").write.mode("overwrite").parquet(f"{path}/metrics")
    (
        equity.withColumn("year", F.year("date"))
        .hint("rebalance", F.col("year"))
        .write.mode("overwrite")
        .partitionBy("year")
        .parquet(f"{path}/equity")
    )
