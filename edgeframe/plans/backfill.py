"""Backfill of landed observations in chunks, resumed from a manifest.

The spans of the stations are cut into chunks of days (``weather.backfill_chunks``). A wave takes
the oldest chunks that nobody has committed, claims them in the manifest, reads their observations
only, writes them as daily rows under a batch of its own, and then commits the chunks with their
row counts. A job that stops at any point loses at most its running wave: what was written without
a commit is never read, and the next job takes what is not committed.

Claims only keep jobs that run side by side from doing the same work. Two that race commit the
same chunk twice; the batch with the smallest name counts, so days never double.

A span may grow at its end: its last chunk then is longer, is read again and replaces the shorter
one. Spans of a station that overlap or touch are one span. Another start would cut other chunks
over the same days, so it needs a folder of its own and is an error here, as is a chunk length
other than the first one's. Spans without a station, a start or an end, or that end before they
start, have no chunks. Observations of other stations or days are not read into the table.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from edgeframe import schemas
from edgeframe.defaults import CHUNK_DAYS
from edgeframe.schemas import record
from edgeframe.sources import weather
from edgeframe.storage import children

CHUNK = ["station", "chunk_start", "chunk_end"]
MANIFEST = record(
    station="string", chunk_start="date", chunk_end="date", state="string", batch="string",
    at="double", rows="long",
)
DATA = record(
    station="string", date="date", tmax_f="double", tmin_f="double", humidity="double",
    wind_mph="double", chunk_start="date", chunk_end="date", batch="string",
)

#: Chunks of a wave, and how long a claim holds off other jobs.
WAVE_CHUNKS = 100_000
CLAIM_SECONDS = 6 * 3600.0


def merged_spans(spans: DataFrame) -> DataFrame:
    """(station, start, end) where spans of a station neither overlap nor touch.

    A station has few spans; equal ones are one before they meet in a task.
    """
    order = Window.partitionBy("station").orderBy("start", "end")
    reach = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.coalesce(F.col("start") > F.date_add(reach, 1), F.lit(True)).cast("int")
    known = F.col("station").isNotNull() & (F.col("start") <= F.col("end"))
    return (
        spans.select("station", "start", "end")
        .where(known)
        .distinct()
        .withColumn("_opens", opens)
        .withColumn("_span", F.sum("_opens").over(order))
        .groupBy("station", "_span")
        .agg(F.min("start").alias("start"), F.max("end").alias("end"))
        .drop("_span")
    )


def planned(spans: DataFrame, days: int = CHUNK_DAYS) -> DataFrame:
    return weather.backfill_chunks(merged_spans(spans), days=days).select(*CHUNK)


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """Claims and commits so far; empty before the first wave."""
    if not children(spark, f"{path}/manifest"):
        return spark.createDataFrame([], MANIFEST)
    return spark.read.schema(MANIFEST).parquet(f"{path}/manifest")


def committed(spark: SparkSession, path: str) -> DataFrame:
    """The batch that counts for each chunk: of the longest with its start, the smallest name."""
    done = manifest(spark, path).where(F.col("state") == "committed")
    best = F.struct("chunk_end", "batch", "rows")
    longest = done.groupBy("station", "chunk_start").agg(F.max("chunk_end").alias("chunk_end"))
    return (
        done.join(longest, CHUNK)
        .groupBy("station", "chunk_start")
        .agg(F.min(best).alias("_b"))
        .select("station", "chunk_start", "_b.*")
        .select(*CHUNK, "batch", "rows")
    )


def pending(
    spark: SparkSession, plan: DataFrame, path: str, claim_seconds: float = CLAIM_SECONDS
) -> DataFrame:
    """Planned chunks that are neither committed nor claimed a short time ago."""
    fresh = F.col("at") > F.lit(time.time() - claim_seconds)
    taken = manifest(spark, path).where((F.col("state") == "committed") | fresh)
    return plan.join(taken.select(*CHUNK).distinct(), CHUNK, "left_anti")


def _check_grid(spark: SparkSession, plan: DataFrame, path: str) -> None:
    """Committed chunks of planned stations start and, but for the last one, end as planned."""
    starts = plan.select("station", "chunk_start", F.col("chunk_end").alias("_end"))
    stations = plan.select("station").distinct()
    own = committed(spark, path).join(stations, "station", "left_semi")
    moved = own.join(starts, ["station", "chunk_start"], "left").where(
        F.col("_end").isNull() | (F.col("chunk_end") > F.col("_end"))
    )
    first = moved.select(*CHUNK).limit(1).collect()
    if first:
        raise ValueError(f"a committed chunk is not in the plan: {first[0].asDict()}")


def backfill(
    spark: SparkSession,
    observations: DataFrame,
    spans: DataFrame,
    path: str,
    days: int = CHUNK_DAYS,
    wave_chunks: int = WAVE_CHUNKS,
    waves: int | None = None,
    claim_seconds: float = CLAIM_SECONDS,
) -> int:
    """Backfill all pending chunks (or ``waves`` waves of them); return how many waves ran.

    ``observations`` are long rows (station, date, datatype, value), ``spans`` have station,
    start and end. Whatever runs at the driver is the number of a wave.
    """
    plan = planned(spans, days)
    _check_grid(spark, plan, path)
    ran = 0
    while waves is None or ran < waves:
        left = pending(spark, plan, path, claim_seconds)
        batch = f"{time.time_ns():020d}-{uuid.uuid4().hex}"
        wave = left.orderBy("chunk_start", "station", "chunk_end").limit(wave_chunks)
        _log(wave.withColumn("rows", F.lit(None).cast("long")), "claimed", batch, path)
        wave = _claimed(spark, path, batch)
        bounds = wave.agg(F.min("chunk_start"), F.max("chunk_end")).first()
        if bounds[0] is None:
            return ran
        _write_wave(observations, wave, bounds, batch, path)
        written = spark.read.schema(DATA).parquet(f"{path}/data/batch={batch}")
        counts = written.groupBy(*CHUNK).agg(F.count(F.lit(1)).alias("rows"))
        done = wave.join(counts, CHUNK, "left").withColumn(
            "rows", F.coalesce("rows", F.lit(0).cast("long"))
        )
        _log(done, "committed", batch, path)
        ran += 1
    return ran


def _claimed(spark: SparkSession, path: str, batch: str) -> DataFrame:
    mine = (F.col("state") == "claimed") & (F.col("batch") == batch)
    return manifest(spark, path).where(mine).select(*CHUNK)


def _log(chunks: DataFrame, state: str, batch: str, path: str) -> None:
    (
        chunks.select(
            *CHUNK,
            F.lit(state).alias("state"),
            F.lit(batch).alias("batch"),
            F.lit(time.time()).alias("at"),
            "rows",
        )
        .write.mode("append")
        .parquet(f"{path}/manifest")
    )


def _write_wave(observations: DataFrame, wave: DataFrame, bounds, batch: str, path: str) -> None:
    """Daily rows of the wave's chunks, each with its chunk.

    Chunks are looked up by (station, year): a row meets the chunks of its station that touch
    its year, of which one holds its day.
    """
    years = F.explode(F.sequence(F.year("chunk_start"), F.year("chunk_end")))
    by_year = wave.withColumn("_year", years)
    day = F.to_date("date")
    held = (
        observations.where(day.between(*bounds))
        .withColumns({"date": day, "_year": F.year(day)})
        .join(by_year, ["station", "_year"])
        .where(F.col("date").between(F.col("chunk_start"), F.col("chunk_end")))
    )
    daily = weather.observations_wide(held.select("station", "date", "datatype", "value"))
    chunked = (
        daily.withColumn("_year", F.year("date"))
        .join(by_year, ["station", "_year"])
        .where(F.col("date").between(F.col("chunk_start"), F.col("chunk_end")))
    )
    columns = [f.name for f in DATA if f.name != "batch"]
    chunked.select(*columns).write.parquet(f"{path}/data/batch={batch}")


def read_backfill(spark: SparkSession, path: str) -> DataFrame:
    """Daily rows of all committed chunks, in the shape of ``weather.read_daily``."""
    columns = schemas.RAW_WEATHER.names
    if not children(spark, f"{path}/data"):
        return spark.createDataFrame([], schemas.RAW_WEATHER)
    rows = spark.read.schema(DATA).option("basePath", f"{path}/data").parquet(f"{path}/data")
    counted = committed(spark, path).where(F.col("rows") > 0).select(*CHUNK, "batch")
    return rows.join(counted, [*CHUNK, "batch"], "left_semi").select(*columns)
