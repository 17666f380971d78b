"""The quote monitor as streams: arbitrage per event and message counts per tick."""

from __future__ import annotations

from collections.abc import Sequence
from contextlib import ExitStack

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from edgeframe.defaults import LATENCY_SAMPLES, MIN_SPREAD_PCT, SEQ_BLOCK, SIGNALS_KEPT, TICK_NS
from edgeframe.operators.book import arb_events, signals_of, usable
from edgeframe.operators.monitor import rolling_latency, running_stats, stats_records, tick_of
from edgeframe.sources.quotes import latency_us
from edgeframe.storage import remove, scratch, staged
from edgeframe.streaming import tables

VENUE_KEY = ["market", "venue"]


class ArbStream:
    """Arbitrage signals of a quote stream.

    The state is one latest quote per (market, venue), carried from batch to batch as a
    table in buckets of markets; a batch reads and writes the buckets of its markets only. Each micro-batch is an ordinary batch job whose markets are cut into blocks, so
    a market with a third of all quotes does not tie the stream to one task.

    All venues take part from their first quote on, unless a list is given. A quote whose
    sequence number is not above the last one of its market and venue, or repeats one of its
    batch, is late: it is counted and otherwise left out. Quotes without a number (null) are
    ordered by their receive time and late against such times only, so a feed may mix both; within a
    batch its numbered quotes come first. A null market or venue is a key. Signals are written to one folder per batch, so a repeated batch
    replaces its own output. The newest ``feed`` signals of each market are a table of their own,
    to which a batch adds its signals only.
    """

    def __init__(
        self, path: str, venues: Sequence[str] | None = None,
        min_spread: float = MIN_SPREAD_PCT, block_size: int = SEQ_BLOCK, feed: int = SIGNALS_KEPT,
    ):
        self.path, self.min_spread = path, min_spread
        rule = tables.Rule(
            VENUE_KEY, ["_turn", "seq"], total=["late"], high=["_last_number", "_last_time"]
        )
        self._book = tables.KeyedTable(f"{path}/book", rule, by=["market"])
        self._feed = tables.capped_sink(f"{path}/feed", ["market"], ["ts_ns", "seq"], feed)
        self.venues = None if venues is None else list(venues)
        self.block_size = block_size

    def start(self, quotes: DataFrame, **trigger) -> StreamingQuery:
        """Run until stopped, or over what is there with ``availableNow=True``."""
        writer = (
            quotes.writeStream.foreachBatch(self.process)
            .option("checkpointLocation", f"{self.path}/checkpoint")
        )
        return (writer.trigger(**trigger) if trigger else writer).start()

    def process(self, batch: DataFrame, batch_id: int) -> None:
        quotes = usable(batch).withColumns(
            {"_numbered": F.col("seq").isNotNull(), "seq": F.coalesce("seq", "recv_ns")}
        )
        with ExitStack() as kept:
            self._process(quotes, batch_id, kept)

    def _process(self, quotes: DataFrame, batch_id: int, kept: ExitStack) -> None:
        spark = quotes.sparkSession

        def held(df: DataFrame, name: str) -> DataFrame:
            """``df`` in files until the batch is done, as several jobs read it.

            Files are read in as many tasks as their size asks for; a persisted table would keep
            its shuffle partitions, however small, and every job would run that many tasks.
            """
            path = scratch(spark, name)
            kept.callback(remove, spark, path)
            return staged(df, name, path)

        kept.callback(quotes.persist().unpersist)
        known = self._book.previous(spark, batch_id, self._book.touched(quotes))
        if known is None:
            empty = spark.createDataFrame([], quotes.drop("_numbered").schema)
            known = empty.withColumns(
                {c: F.lit(None).cast("long") for c in ("late", "_last_number", "_last_time", "_turn")}
            )
        else:
            markets = quotes.select(F.col("market").alias("_m")).distinct()
            known = held(known.join(markets, F.col("market").eqNullSafe(F.col("_m")), "left_semi"), "arb-known")
        same = Window.partitionBy(*VENUE_KEY, "_numbered", "seq").orderBy("recv_ns", "yes_bid", "yes_ask")
        copies = quotes.withColumn("_copy", F.row_number().over(same))
        seen = known.select(*[F.col(k).alias(f"_{k}") for k in VENUE_KEY], "_last_number", "_last_time")
        here = F.lit(True)
        for k in VENUE_KEY:
            here = here & F.col(k).eqNullSafe(F.col(f"_{k}"))
        passed = F.when(F.col("_numbered"), F.col("_last_number")).otherwise(F.col("_last_time"))
        late = F.coalesce(F.col("seq") <= passed, F.lit(False)) | (F.col("_copy") > 1)
        checked = held(
            copies.join(seen, here, "left").withColumn("_late", late).drop(*seen.columns, "_copy"),
            "arb-checked",
        )
        fresh = checked.where(~F.col("_late")).withColumn("_known", F.lit(False))
        rows = fresh.drop("_late", "_numbered").unionByName(
            known.drop("late", "_last_number", "_last_time", "_turn").withColumn("_known", F.lit(True))
        )
        # The book so far comes before all new quotes.
        events = arb_events(
            rows, self.venues, self.min_spread, rows=self.block_size, first=F.col("_known"), crossed=True
        )
        signals = signals_of(events.where(~F.col("_known")))
        written = f"{self.path}/signals/batch={batch_id}"
        signals.write.mode("overwrite").parquet(written)
        self._feed(spark.read.schema(signals.schema).parquet(written), batch_id)

        counted = checked.withColumns(
            {
                "late": F.col("_late").cast("long"),
                "_last_number": F.when(F.col("_numbered"), F.col("seq")),
                "_last_time": F.when(~F.col("_numbered"), F.col("seq")),
                # An accepted quote follows those of earlier batches, whichever have numbers;
                # a late one is behind a quote that is there already.
                "_turn": F.when(F.col("_late"), -1).otherwise(batch_id).cast("long"),
            }
        )
        self._book.update(counted.drop("_late", "_numbered"), batch_id)

    def signals(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(f"{self.path}/signals").drop("batch")

    def feed(self, spark: SparkSession) -> DataFrame:
        """The newest signals of each market, without reading the older ones."""
        return tables.current(spark, f"{self.path}/feed")

    def late(self, spark: SparkSession) -> DataFrame:
        """Late quotes of each market and venue so far."""
        return self.book(spark).select(*VENUE_KEY, "late").where(F.col("late") > 0)

    def book(self, spark: SparkSession) -> DataFrame:
        return self._book.current(spark).drop("_last_number", "_last_time", "_turn")


class TickTable:
    """Messages and latency samples of every (market, tick) so far, however late they come.

    There is no watermark, so ticks that are still open are there and no row is dropped. The counts
    are a keyed table to which a micro-batch adds its own. Its latency samples, four numbers a row,
    are written to one folder, which a repeated batch replaces.
    """

    def __init__(self, path: str, tick_ns: int = TICK_NS):
        self.path, self.tick_ns = path, tick_ns
        rule = tables.Rule(
            ["market", "tick"], [], total=["messages", "samples"], high=["last_ns"], low=["first_ns"]
        )
        self._counts = tables.KeyedTable(f"{path}/counts", rule)

    def start(self, quotes: DataFrame, **trigger) -> StreamingQuery:
        """Run until stopped, or over what is there with ``availableNow=True``."""
        writer = (
            quotes.writeStream.foreachBatch(self.process)
            .option("checkpointLocation", f"{self.path}/checkpoint")
        )
        return (writer.trigger(**trigger) if trigger else writer).start()

    def process(self, batch: DataFrame, batch_id: int) -> None:
        counts = batch.groupBy("market", tick_of(self.tick_ns).alias("tick")).agg(
            F.count(F.lit(1)).alias("messages"),
            F.sum(F.coalesce((latency_us() >= 0).cast("long"), F.lit(0))).alias("samples"),
            F.max("recv_ns").alias("last_ns"),
            F.min("recv_ns").alias("first_ns"),
        )
        self._counts.update(counts, batch_id)
        number = F.coalesce("seq", "recv_ns").alias("seq")
        samples = batch.where(latency_us() >= 0).select("market", "recv_ns", "ts_ns", number)
        samples.write.mode("overwrite").parquet(f"{self.path}/samples/batch={batch_id}")

    def _counted(self, spark: SparkSession) -> DataFrame:
        return self._counts.current(spark)

    def ticks(self, spark: SparkSession) -> DataFrame:
        """``market``, ``tick_start_ns``, ``messages``, ``samples`` of all ticks with a message."""
        return (
            self._counted(spark).select(
                "market", (F.col("tick") * self.tick_ns).alias("tick_start_ns"), "messages", "samples"
            )
        )

    def samples(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(f"{self.path}/samples").drop("batch")

    def engine_stats(
        self, spark: SparkSession, signals: DataFrame, samples: int = LATENCY_SAMPLES
    ) -> DataFrame:
        """The records of ``monitor.engine_stats`` for all that has come in so far."""
        counts = counts_of(self.ticks(spark), signals, self.tick_ns)
        started = self._counted(spark).groupBy("market").agg(F.min("first_ns").alias("started_at_ns"))
        latency = rolling_latency(self.samples(spark), self.tick_ns, samples)
        return stats_records(running_stats(counts, self.tick_ns), started, latency, self.tick_ns)

    def final_before(self, spark: SparkSession, lateness_ns: int) -> int | None:
        """Ticks that end by this time lie ``lateness_ns`` behind the newest row; None without rows."""
        newest = self._counted(spark).agg(F.max("last_ns")).first()[0]
        return None if newest is None else newest - lateness_ns


def tick_stream(
    quotes: DataFrame, tick: str = "1 second", lateness: str = "10 seconds"
) -> DataFrame:
    """Messages and latency samples per (market, tick), final once the watermark passes.

    Only closed ticks come out, and rows behind the watermark are dropped: ``TickTable`` has
    both. Ticks without messages cannot appear here; ``monitor.running_stats`` adds them when
    it reads this stream's output.
    """
    received = F.timestamp_micros(F.expr("recv_ns div 1000"))
    return (
        quotes.withColumn("_received", received)
        .withWatermark("_received", lateness)
        .groupBy(F.window("_received", tick).alias("_w"), "market")
        .agg(
            F.count(F.lit(1)).alias("messages"),
            F.sum((latency_us() >= 0).cast("long")).alias("samples"),
        )
        .select(
            "market",
            (F.unix_micros(F.col("_w.start")) * 1000).alias("tick_start_ns"),
            "messages",
            "samples",
        )
    )


def counts_of(ticks: DataFrame, signals: DataFrame, tick_ns: int = TICK_NS) -> DataFrame:
    """Tick counts and the signal table as input of ``monitor.running_stats``.

    Signals of a tick that ``ticks`` does not have are kept, with no messages.
    """
    found = signals.groupBy("market", tick_of(tick_ns, "ts_ns").alias("tick")).agg(
        F.count(F.lit(1)).alias("signals")
    )
    counted = ticks.select(
        "market", tick_of(tick_ns, "tick_start_ns").alias("tick"), "messages", "samples"
    )
    return counted.join(found, ["market", "tick"], "full").fillna(
        0, subset=["messages", "samples", "signals"]
    )


def append_table(
    stream: DataFrame, path: str, checkpoint: str, **trigger
) -> StreamingQuery:
    """Append a stream to a Parquet table exactly once."""
    writer = stream.writeStream.format("parquet").outputMode("append").option(
        "checkpointLocation", checkpoint
    )
    return (writer.trigger(**trigger) if trigger else writer).start(path)
