"""The jobs as ``spark-submit`` commands: backfill, ingest, study, monitor, stats.

    spark-submit --py-files edgeframe.zip -m edgeframe.jobs ingest --primary ... --lake ...
"""

from __future__ import annotations

import argparse
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from edgeframe.defaults import TICK_NS
from edgeframe.operators import monitor as stats_ops
from edgeframe.plans import backfill, forecast, ingest
from edgeframe.session import ship
from edgeframe.sources import lake, quotes, weather
from edgeframe.streaming import monitor as streams

#: How far behind the newest quote a tick must end to be in ``stats``.
LATENESS_NS = 10_000_000_000


def run_backfill(spark: SparkSession, args: argparse.Namespace) -> int:
    """Landed observations of the spans into daily rows, chunk by chunk, from where it stopped."""
    rows = weather.read_observations(spark, args.observations)
    if args.source_ids:
        named = rows.withColumnRenamed("station", "external_id")
        rows = weather.with_station_id(named, weather.station_ids(spark), "external_id")
    spans = spark.read.parquet(args.spans)
    return backfill.backfill(spark, rows, spans, args.out, waves=args.waves)


def run_ingest(spark: SparkSession, args: argparse.Namespace) -> dict:
    """Observations (or daily weather) and a fallback to the feature lake."""
    if args.format == "observations":
        primary = weather.observations_wide(weather.read_observations(spark, args.primary))
    elif args.format == "backfill":
        parts = [backfill.read_backfill(spark, path) for path in args.primary]
        primary = weather.append_chunks(parts)
    else:
        primary = weather.read_daily(spark, args.primary, args.format, "primary" in args.contract)
    fallback = weather.read_daily(spark, args.fallback, contract="fallback" in args.contract)
    return ingest.ingest(spark, primary, fallback, args.lake, args.warmup, args.pricing)


def run_study(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    """Train, search, calibrate, backtest; then publish the live forecast."""
    rows = lake.read_lake(spark, args.lake)
    study = forecast.run_study(spark, rows, args.out, args.method)
    forecast.publish_live(rows, study.fitted, time.time_ns(), f"{args.out}/live")
    return study.metrics


def run_monitor(spark: SparkSession, args: argparse.Namespace) -> None:
    """Arbitrage signals and tick counts from landed files or Kafka, until stopped."""
    if args.kafka:
        messages = quotes.kafka_messages(spark, args.kafka)
    else:
        messages = quotes.message_stream(spark, args.landing)
    decoded = quotes.decode_quotes(quotes.subscribe(messages), arrival=True)
    trigger = {"availableNow": True} if args.once else {"processingTime": "1 second"}
    signals = streams.ArbStream(f"{args.out}/arb", args.venues)
    running = [
        signals.start(decoded, **trigger),
        streams.TickTable(f"{args.out}/tick-table").start(decoded, **trigger),
    ]
    for query in running:
        query.awaitTermination()


def run_stats(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    """Counters and availability per tick from the monitor's tables, and the newest signals.

    ``stats_all`` has every tick and signal there is, and ``engine_stats`` whole records of them,
    latencies, start and uptime included. ``stats``, which is returned, has the ticks that end
    ``LATENESS_NS`` before the newest quote, and so rarely change any more. ``feed`` comes from the
    table that the monitor keeps.
    """
    arb = streams.ArbStream(f"{args.out}/arb", args.venues)
    signals = arb.signals(spark)
    table = streams.TickTable(f"{args.out}/tick-table")
    counts = streams.counts_of(table.ticks(spark), signals)
    stats_ops.running_stats(counts).write.mode("overwrite").parquet(f"{args.out}/stats_all")
    closed = (F.col("tick") + 1) * TICK_NS <= F.lit(table.final_before(spark, LATENESS_NS))
    stats = stats_ops.running_stats(counts.where(closed))
    stats.write.mode("overwrite").parquet(f"{args.out}/stats")
    table.engine_stats(spark, signals).write.mode("overwrite").parquet(f"{args.out}/engine_stats")
    arb.feed(spark).write.mode("overwrite").parquet(f"{args.out}/feed")
    return spark.read.parquet(f"{args.out}/stats")


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="edgeframe.jobs")
    commands = top.add_subparsers(required=True)

    job = commands.add_parser("backfill")
    job.add_argument("--observations", nargs="+", required=True)
    job.add_argument("--spans", required=True, help="Parquet with station, start and end")
    job.add_argument("--out", required=True)
    job.add_argument("--waves", type=int, help="stop after so many waves")
    job.add_argument(
        "--source-ids", action="store_true", help="observations carry the source's station ids"
    )
    job.set_defaults(run=run_backfill)

    job = commands.add_parser("ingest")
    job.add_argument("--primary", nargs="+", required=True)
    job.add_argument("--fallback", required=True)
    job.add_argument("--lake", required=True)
    job.add_argument(
        "--format", default="observations",
        choices=["observations", "backfill", "parquet", "csv", "json", "orc"],
    )
    job.add_argument(
        "--contract", nargs="*", default=[], choices=["primary", "fallback"],
        help="daily sources that carry labels and prices of their own",
    )
    job.add_argument("--warmup", default="partial", choices=["partial", "full"])
    job.add_argument("--pricing", default="naive", choices=["naive", "informed"])
    job.set_defaults(run=run_ingest)

    job = commands.add_parser("study")
    job.add_argument("--lake", required=True)
    job.add_argument("--out", required=True)
    job.add_argument("--method", default="grid-search", choices=["grid-search", "grid-refine", "adaptive"])
    job.set_defaults(run=run_study)

    for name, run in (("monitor", run_monitor), ("stats", run_stats)):
        job = commands.add_parser(name)
        job.add_argument("--out", required=True)
        job.add_argument("--venues", nargs="+", help="only these; all there are if not given")
        if name == "monitor":
            source = job.add_mutually_exclusive_group(required=True)
            source.add_argument("--landing")
            source.add_argument("--kafka")
            job.add_argument("--once", action="store_true", help="stop when nothing is left")
        job.set_defaults(run=run)
    return top


def main(arguments: list[str] | None = None):
    args = parser().parse_args(arguments)
    spark = SparkSession.builder.appName("edgeframe").getOrCreate()
    ship(spark)
    return args.run(spark, args)


if __name__ == "__main__":
    main()
