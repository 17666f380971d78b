"""Latest-value tables, capped newest-first lists, and the read-side views."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from edgeframe.defaults import SIGNALS_KEPT
from edgeframe.functions.numeric import percent
from edgeframe.operators.blocks import newest


def latest_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row of each key that is last in the order, as one mergeable aggregate."""
    rest = [c for c in df.columns if c not in keys]
    row = F.max_by(F.struct(*rest), F.struct(*order))
    return df.groupBy(*keys).agg(row.alias("_row")).select(*keys, "_row.*").select(*df.columns)


def capped_list(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], n: int = SIGNALS_KEPT
) -> DataFrame:
    """The newest ``n`` rows of each key; ``place`` 1 is the newest."""
    return newest(df, keys, order, n).withColumnRenamed("_rank", "place")


def read_newest(
    items: DataFrame, schema: T.StructType, count: int, body: str = "payload"
) -> DataFrame:
    """Decode the first ``count`` places of capped lists; undecodable items are left out.

    The limit is applied before decoding, so a bad item uses up a place.
    """
    declared = T.StructType([*schema.fields, T.StructField("_bad", T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}
    names = [f.name for f in schema.fields]
    keep = [c for c in items.columns if c != body and c not in names]
    return (
        items.where(F.col("place") <= count)
        .withColumn("_v", F.from_json(body, declared, options))
        .where(F.col("_v").isNotNull() & F.col("_v._bad").isNull())
        .select(*keep, *[F.col(f"_v.{n}").alias(n) for n in names])
    )


def point_read(
    wanted: DataFrame,
    store: DataFrame,
    schema: T.StructType,
    default: dict | None = None,
    key: str = "key",
    body: str = "payload",
) -> DataFrame:
    """Value of each wanted key; the defaults where it is missing or cannot be decoded."""
    declared = T.StructType([*schema.fields, T.StructField("_bad", T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}
    value = F.from_json(body, declared, options)
    default = default or {}

    def field(f: T.StructField) -> Column:
        good = F.when(F.col("_v._bad").isNull(), F.col(f"_v.{f.name}"))
        missing = F.lit(default.get(f.name)).cast(f.dataType)
        return F.when(F.col("_found"), good).otherwise(missing).alias(f.name)

    return (
        wanted.join(store, key, "left")
        .withColumn("_v", value)
        .withColumn("_found", F.col("_v").isNotNull() & F.col("_v._bad").isNull())
        .select(*wanted.columns, *[field(f) for f in schema.fields])
    )


def signal_view(signals: DataFrame, shown: int = 25, fetched: int = 50) -> DataFrame:
    """The ``shown`` newest signals with the spread in percent and the display columns only."""
    order = [F.col(c).desc() for c in ("ts_ns", "seq", "market") if c in signals.columns]
    recent = signals.orderBy(*order).limit(fetched).orderBy(*order).limit(shown)
    if "spread_pct" in recent.columns:
        recent = recent.withColumn(
            "spread_%", F.round(F.col("spread_pct") * F.lit(100.0), 3)
        )
    display = ["market", "buy_venue", "sell_venue", "buy_price", "sell_price", "spread_%",
               "latency_us"]
    return recent.select(*[c for c in display if c in recent.columns])


def equity_view(equity: DataFrame) -> DataFrame:
    """Equity curve with typed dates, ordered for display."""
    return equity.select("market", F.to_date("date").alias("date"), "equity").orderBy(
        "market", "date"
    )


def forecast_view(forecast: DataFrame, odds: DataFrame, sizing: DataFrame) -> DataFrame:
    """Newest forecast, odds and sizing of each market in one row, with percent texts."""
    key, order = ["market"], ["ts_ns"]
    f = latest_by_key(forecast, key, order).drop("ts_ns")
    o = latest_by_key(odds, key, order).drop("ts_ns").withColumnRenamed("edge", "odds_edge")
    s = latest_by_key(sizing, key, order).drop("ts_ns")
    return f.join(o, "market", "left").join(s, "market", "left").withColumns(
        {
            "ensemble_pct": percent(F.col("ensemble_prob")),
            "lstm_pct": percent(F.col("lstm_prob")),
            "transformer_pct": percent(F.col("transformer_prob")),
            "model_pct": percent(F.col("model_prob")),
            "market_pct": percent(F.col("market_prob")),
            "edge_pct": percent(F.col("odds_edge")),
        }
    )


def backtest_view(metrics: DataFrame) -> DataFrame:
    """Backtest summary with the rates as percent text."""
    return metrics.withColumns(
        {
            "avg_edge_pct": percent(F.col("avg_edge")),
            "monthly_roi_pct": percent(F.col("monthly_roi")),
            "max_drawdown_pct": percent(F.col("max_drawdown")),
            "hit_rate_pct": percent(F.col("hit_rate"), 1),
            "total_return_pct": percent(F.col("total_return")),
        }
    )


def health_view(stats: DataFrame) -> DataFrame:
    """The newest stats record of each market."""
    return latest_by_key(stats, ["market"], ["tick"])


def venue_quotes(latest: DataFrame, venues: DataFrame) -> DataFrame:
    """Latest quotes of the listed venues; venues without a quote are skipped."""
    return latest.join(venues.select("venue").distinct(), "venue")
