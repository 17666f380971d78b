"""Per-tick engine statistics: counters, silent ticks, availability, latency percentiles."""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from edgeframe.defaults import LATENCY_SAMPLES, TICK_NS
from edgeframe.operators.blocks import (
    BLOCK,
    block_counts,
    bounded_blocks,
    earlier_blocks,
    positions,
    prefix_sums,
)
from edgeframe.operators.book import arb_events, usable
from edgeframe.sources.quotes import latency_us

TICKS_PER_BLOCK = 4096
LATENCY_BLOCK_US = 256


def tick_of(tick_ns: int = TICK_NS, time: str = "recv_ns") -> Column:
    return F.expr(f"{time} div {tick_ns}")


def tick_counts(
    events: DataFrame, tick_ns: int = TICK_NS, signal: Column | None = None
) -> DataFrame:
    """Messages, signals and latency samples of each (market, tick) that had any message."""
    signal = F.lit(False) if signal is None else signal
    return events.groupBy("market", tick_of(tick_ns).alias("tick")).agg(
        F.count(F.lit(1)).alias("messages"),
        F.sum(F.coalesce(signal, F.lit(False)).cast("long")).alias("signals"),
        F.sum((latency_us() >= 0).cast("long")).alias("samples"),
    )


def with_silent_ticks(counts: DataFrame, until: int | None = None) -> DataFrame:
    """All ticks from a market's first message on, zero-filled where nothing arrived.

    Ends at the market's last message, or at tick ``until``. Ticks are generated block by
    block, so no row ever holds the whole range of a market.
    """
    last = F.max("tick") if until is None else F.greatest(F.max("tick"), F.lit(until))
    spans = counts.groupBy("market").agg(F.min("tick").alias("_lo"), last.alias("_hi"))
    size = TICKS_PER_BLOCK
    blocks = spans.withColumn(
        BLOCK, F.explode(F.expr(f"sequence(_lo div {size}, _hi div {size})"))
    ).repartition("market", BLOCK)
    first = F.greatest(F.col("_lo"), F.col(BLOCK) * size)
    final = F.least(F.col("_hi"), F.col(BLOCK) * size + (size - 1))
    spine = blocks.select("market", BLOCK, F.explode(F.sequence(first, final)).alias("tick"))
    return (
        spine.join(counts, ["market", "tick"], "left")
        .fillna(0, subset=["messages", "signals", "samples"])
    )


def running_stats(
    counts: DataFrame, tick_ns: int = TICK_NS, until: int | None = None
) -> DataFrame:
    """Cumulative counters and availability after every tick, silent ticks included."""
    ticks = with_silent_ticks(counts, until)
    totals = prefix_sums(
        ticks,
        ["market"],
        ["tick"],
        {
            "messages_processed": F.col("messages"),
            "arb_opportunities": F.col("signals"),
            "sample_count": F.col("samples"),
            "_healthy": (F.col("messages") > 0).cast("long"),
            "_ticks": F.lit(1),
        },
    )
    return totals.select(
        "market",
        "tick",
        "messages",
        "messages_processed",
        "arb_opportunities",
        F.col("arb_opportunities").alias("trades_executed"),
        "sample_count",
        (F.col("messages") / F.lit(tick_ns / 1e9)).alias("msgs_per_sec"),
        (F.lit(100.0) * F.col("_healthy") / F.col("_ticks")).alias("uptime_pct"),
    )


def rolling_latency(
    events: DataFrame,
    tick_ns: int = TICK_NS,
    samples: int = LATENCY_SAMPLES,
    percentiles: Sequence[float] = (50.0, 99.0),
) -> DataFrame:
    """Percentiles over the last ``samples`` non-negative latencies after each tick.

    Samples are numbered per market (in blocks bounded in rows, however many a tick has) and cut
    into rings of ``samples`` consecutive numbers; a ring and the one before it hold every window
    that ends in it. A task therefore sees at most two rings of numbers, however busy the market
    is, and keeps the window sorted from tick to tick.
    """
    usable = (
        events.withColumn("_us", latency_us())
        .where(F.col("_us") >= 0)
        .select("market", "recv_ns", "seq", "_us")
    )
    blocked, _ = bounded_blocks(usable.where(F.col("market").isNotNull()), ["market"], F.col("recv_ns"))
    numbered = positions(blocked, ["market"], ["recv_ns", "seq", "_us"])
    usable = usable.withColumn(BLOCK, tick_of(tick_ns))
    held = numbered.select(
        "market",
        F.explode(F.expr(f"array(_pos div {samples}, _pos div {samples} + 1)")).alias("ring"),
        "_pos",
        "_us",
    )
    ends = block_counts(usable, ["market"]).select(
        F.col("market").alias("market"),  # a fresh column: both sides come from one table
        F.col(BLOCK).alias("tick"),
        (F.col("_before") + F.col("_cnt")).alias("sample_count"),
    )
    ends = ends.withColumn("ring", F.expr(f"(sample_count - 1) div {samples}"))
    names = [f"latency_us_p{p:g}" for p in percentiles]
    shares = [p / 100.0 for p in percentiles]

    def select(held: pd.DataFrame, ends: pd.DataFrame) -> pd.DataFrame:
        held, ends = held.sort_values("_pos"), ends.sort_values("sample_count")
        us, base = held["_us"].tolist(), int(held["_pos"].min()) if len(held) else 0
        found = np.empty((len(ends), len(shares)))
        window: list[float] = []  # sorted; what enters and leaves between ticks moves in it
        first = last = 0
        for i, end in enumerate(ends["sample_count"].tolist()):
            start, stop = max(end - samples, 0) - base, end - base
            if stop - last > len(window) // 16:
                window = sorted(us[start:stop])
            else:
                for value in us[last:stop]:
                    insort(window, value)
                for value in us[first:start]:
                    del window[bisect_left(window, value)]
            first, last = start, stop
            found[i] = [window[int(share * (len(window) - 1))] for share in shares]
        return ends[["market", "tick", "sample_count"]].assign(
            **{name: found[:, j] for j, name in enumerate(names)}
        )

    schema = "market string, tick long, sample_count long, " + ", ".join(
        f"`{name}` double" for name in names
    )
    key = ["market", "ring"]
    return held.groupBy(*key).cogroup(ends.groupBy(*key)).applyInPandas(select, schema)


def latency_percentiles(
    events: DataFrame,
    percentiles: Sequence[float] = (50.0, 99.0),
    value: Column | None = None,
    block_us: int = LATENCY_BLOCK_US,
) -> DataFrame:
    """Exact lower-nearest-rank percentiles of all non-negative latencies of each market.

    Latencies are counted per distinct value before any shuffle; block totals tell which
    block of values holds each rank, and only that block is searched.
    """
    value = latency_us() if value is None else value
    values = (
        events.select("market", value.alias("_us"))
        .where(F.col("_us") >= 0)
        .groupBy("market", "_us")
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn(BLOCK, F.floor(F.col("_us") / block_us))
    )
    totals = values.groupBy("market", BLOCK).agg(F.sum("_n").alias("_cnt"))
    totals = totals.withColumns(
        {
            "_before": F.coalesce(F.sum("_cnt").over(earlier_blocks(["market"])), F.lit(0)),
            "_total": F.sum("_cnt").over(Window.partitionBy("market")),
        }
    )
    wanted = F.explode(F.array(*[F.lit(float(p)) for p in percentiles]))
    rank = F.floor(F.col("p") / 100.0 * (F.col("_total") - 1))
    targets = (
        totals.withColumn("p", wanted)
        .withColumn("_rank", rank - F.col("_before"))
        .where((F.col("_rank") >= 0) & (F.col("_rank") < F.col("_cnt")))
        .select("market", BLOCK, "p", "_rank")
    )
    within = Window.partitionBy("market", BLOCK, "p").orderBy("_us")
    found = (
        values.join(targets, ["market", BLOCK])
        .withColumn("_upto", F.sum("_n").over(within))
        .where((F.col("_rank") < F.col("_upto")) & (F.col("_rank") >= F.col("_upto") - F.col("_n")))
    )
    return found.groupBy("market").agg(
        *[
            F.max(F.when(F.col("p") == float(p), F.col("_us"))).alias(f"latency_us_p{p:g}")
            for p in percentiles
        ]
    )


def latency_percentiles_approx(
    events: DataFrame, percentiles: Sequence[float] = (50.0, 99.0), accuracy: int = 10000
) -> DataFrame:
    """Approximate percentiles in one mergeable aggregate; error at most 1/accuracy in rank."""
    us = latency_us()
    return (
        events.where(us >= 0)
        .groupBy("market")
        .agg(
            *[
                F.approx_percentile(us, p / 100.0, accuracy).alias(f"latency_us_p{p:g}")
                for p in percentiles
            ]
        )
    )


def engine_stats(
    quotes: DataFrame,
    venues: Sequence[str] | None = None,
    tick_ns: int = TICK_NS,
    samples: int = LATENCY_SAMPLES,
    until: int | None = None,
) -> DataFrame:
    """One stats record per market and tick; counting starts with a market's first message."""
    quotes = usable(quotes)
    counts = tick_counts(arb_events(quotes, venues), tick_ns, F.col("is_signal"))
    ticks = running_stats(counts, tick_ns, until)
    started = quotes.groupBy("market").agg(F.min("recv_ns").alias("started_at_ns"))
    return stats_records(ticks, started, rolling_latency(quotes, tick_ns, samples), tick_ns)


def stats_records(
    ticks: DataFrame, started: DataFrame, latency: DataFrame, tick_ns: int = TICK_NS
) -> DataFrame:
    """All fields of a stats record, from ``running_stats``, ``started_at_ns`` of each market and
    ``rolling_latency``."""
    # Ticks without new samples share the count, and so the latencies, of the tick before.
    latency = latency.drop("tick")
    end_ns = (F.col("tick") + 1) * F.lit(tick_ns)
    return (
        ticks.join(latency, ["market", "sample_count"], "left")
        .join(started, "market")
        .fillna(0.0, subset=["latency_us_p50", "latency_us_p99"])
        .select(
            "market",
            "tick",
            "started_at_ns",
            ((end_ns - F.col("started_at_ns")) / F.lit(1e9)).alias("uptime_seconds"),
            "messages_processed",
            "arb_opportunities",
            "trades_executed",
            "latency_us_p50",
            "latency_us_p99",
            "msgs_per_sec",
            "uptime_pct",
        )
    )
