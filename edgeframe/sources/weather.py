"""Daily weather: declared-schema scans, long-to-wide reshape, source choice, backfill plan."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from edgeframe import schemas
from edgeframe.defaults import (
    CHUNK_DAYS,
    MIN_SOURCE_ROWS,
    NEUTRAL_HUMIDITY,
    NEUTRAL_WIND_MPH,
    STATION_IDS,
)


def read_table(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: T.StructType,
    fmt: str = "parquet",
    **options,
) -> DataFrame:
    """Scan Parquet, ORC, CSV or JSON with a declared schema; nothing passes the driver."""
    if fmt == "csv":
        options = {"header": "true", **options}
    paths = [paths] if isinstance(paths, str) else list(paths)
    return spark.read.format(fmt).schema(schema).options(**options).load(paths)


def read_daily(
    spark: SparkSession, paths: str | Sequence[str], fmt: str = "parquet", contract: bool = False
) -> DataFrame:
    """Raw daily weather, with the contract columns if the files carry them."""
    schema = schemas.CONTRACT_WEATHER if contract else schemas.RAW_WEATHER
    return read_table(spark, paths, schema, fmt).withColumn("date", F.to_date("date"))


def read_observations(
    spark: SparkSession, paths: str | Sequence[str], fmt: str = "json"
) -> DataFrame:
    """Landed long-format observations; several paths (e.g. yearly chunks) are one scan."""
    return read_table(spark, paths, schemas.OBSERVATION, fmt)


def append_chunks(chunks: Sequence[DataFrame]) -> DataFrame:
    """Chunks with possibly missing columns, one below the other."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), chunks)


def observations_wide(observations: DataFrame) -> DataFrame:
    """One row per (station, day) with mean TMAX and TMIN; days without TMAX are dropped.

    Filtering the two datatypes first and averaging map-side keeps the shuffle at one row
    per (station, day, task).
    """
    return (
        observations.where(F.col("datatype").isin("TMAX", "TMIN"))
        .groupBy("station", F.to_date("date").alias("date"))
        .agg(
            F.avg(F.when(F.col("datatype") == "TMAX", F.col("value"))).alias("tmax_f"),
            F.avg(F.when(F.col("datatype") == "TMIN", F.col("value"))).alias("tmin_f"),
        )
        .dropna(subset=["tmax_f"])
        .withColumns(
            {"humidity": F.lit(NEUTRAL_HUMIDITY), "wind_mph": F.lit(NEUTRAL_WIND_MPH)}
        )
    )


def choose_source(
    primary: DataFrame,
    fallback: DataFrame,
    min_rows: int = MIN_SOURCE_ROWS,
    labels: tuple[str, str] = ("primary", "fallback"),
) -> DataFrame:
    """Per station the primary rows if there are more than ``min_rows``, else the fallback.

    The gate is one row per qualifying station: Spark broadcasts it while its measured size
    allows and otherwise joins by shuffle with adaptive skew splitting.
    """
    qualified = (
        primary.groupBy("station").count().where(F.col("count") > min_rows).select("station")
    )
    kept = primary.join(qualified, "station", "left_semi").withColumn("source", F.lit(labels[0]))
    rest = fallback.join(qualified, "station", "left_anti").withColumn("source", F.lit(labels[1]))
    return kept.unionByName(rest, allowMissingColumns=True)


def station_ids(spark: SparkSession) -> DataFrame:
    """Built-in station code to external id table."""
    return spark.createDataFrame(list(STATION_IDS.items()), "station string, external_id string")


def with_station_id(
    df: DataFrame, dimension: DataFrame, key: str | list[str] = "station"
) -> DataFrame:
    """Left join to the station dimension; unknown stations keep null columns."""
    return df.join(dimension, key, "left")


def backfill_chunks(
    spans: DataFrame,
    start: str | Column = "start",
    end: str | Column = "end",
    days: int = CHUNK_DAYS,
) -> DataFrame:
    """Disjoint inclusive date ranges of at most ``days`` days covering [start, end]."""
    start = F.col(start) if isinstance(start, str) else start
    end = F.col(end) if isinstance(end, str) else end
    first = F.explode(F.sequence(start, end, F.make_dt_interval(F.lit(days))))
    return (
        spans.withColumn("_end", end)
        .where(start <= end)
        .withColumn("chunk_start", first)
        .withColumn(
            "chunk_end", F.least(F.date_add("chunk_start", days - 1), F.col("_end"))
        )
        .drop("_end")
    )
