"""The feature ingestion job: choose a source per station, build features, write the lake."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from edgeframe.operators.features import build_features
from edgeframe.sources import lake as lake_io
from edgeframe.sources.weather import choose_source
from edgeframe.storage import scratch


def ingest(
    spark: SparkSession,
    primary: DataFrame,
    fallback: DataFrame,
    path: str,
    warmup: str = "partial",
    pricing: str = "naive",
    status_log: str | None = None,
) -> dict:
    """Write the lake and return the row count; status records frame the run."""
    log = status_log or f"{path}-status"
    lake_io.log_status(spark, log, "ingest_start", "choosing sources")
    try:
        # Features read their rows three times; the sources are read for this table only.
        path_of_daily = scratch(spark, "daily")
        choose_source(primary, fallback).drop("source").write.parquet(path_of_daily)
        daily = spark.read.parquet(path_of_daily)
        summary = lake_io.write_lake(build_features(daily, warmup, pricing), path)
    except Exception as error:
        lake_io.log_status(spark, log, "ingest_error", str(error))
        raise
    lake_io.log_status(spark, log, "ingest_done", f"{summary['rows']} feature rows")
    return summary
