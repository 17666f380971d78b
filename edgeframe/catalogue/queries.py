"""Every operator as a query over the test tables: ``name -> f(spark, sf_dir)``."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from edgeframe import fixtures as fx
from edgeframe import schemas
from edgeframe.functions.numeric import logit, percent, point_estimate, sigmoid
from edgeframe.operators import (
    adaptive,
    backtest,
    book,
    calibrate,
    dataset,
    features,
    models,
    monitor,
    recurrent,
    search,
    serving,
)
from edgeframe.operators.blocks import seq_blocks
from edgeframe.plans import backfill, forecast
from edgeframe.sources import lake, listings, quotes, weather
from edgeframe.storage import scratch
from edgeframe.streaming import monitor as streams
from edgeframe.streaming import tables

HOUR_NS = 3_600_000_000_000


def r6(name: str | Column, alias: str | None = None) -> Column:
    """Rounded to 6 places for the comparison of floating-point results."""
    column = F.col(name) if isinstance(name, str) else name
    return (F.floor(column * 1e6 + 0.5) / 1e6).alias(alias or name)


def _r6(*names: str) -> list[Column]:
    return [r6(n) for n in names]


# --- sources ------------------------------------------------------------------------


def observations_wide(spark: SparkSession, sf: str) -> DataFrame:
    wide = weather.observations_wide(fx.obs_long(spark, sf))
    return wide.select("station", "date", *_r6("tmax_f", "tmin_f"), "humidity", "wind_mph")


def source_gate(spark: SparkSession, sf: str) -> DataFrame:
    daily = fx.obs_daily(spark, sf)
    other = daily.withColumn("tmax_f", F.col("tmax_f") + 100.0)
    return weather.choose_source(daily, other).select("station", "date", "tmax_f", "source")


def station_lookup(spark: SparkSession, sf: str) -> DataFrame:
    nation, region = fx.table(spark, sf, "nation"), fx.table(spark, sf, "region")
    dimension = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.concat(F.lit("S"), F.col("n_nationkey").cast("string")).alias("station"),
        F.col("n_name").alias("external_id"),
        F.col("r_name").alias("region"),
    )
    daily = fx.obs_daily(spark, sf).select("station", "date")
    return weather.with_station_id(daily, dimension)


def backfill_chunks(spark: SparkSession, sf: str) -> DataFrame:
    spans = fx.obs_daily(spark, sf).groupBy("station").agg(
        F.min("date").alias("start"), F.max("date").alias("end")
    )
    return weather.backfill_chunks(spans).select("station", "chunk_start", "chunk_end")


def backfill_resumed(spark: SparkSession, sf: str) -> DataFrame:
    """Observations backfilled by a job that stopped after its first wave and one that resumed."""
    path = scratch(spark, "backfill")
    observations = fx.obs_long(spark, sf)
    day = F.to_date("date")
    spans = observations.groupBy("station").agg(F.min(day).alias("start"), F.max(day).alias("end"))
    backfill.backfill(spark, observations, spans, path, wave_chunks=7, waves=1)
    backfill.backfill(spark, observations, spans, path)
    return backfill.read_backfill(spark, path).select(
        "station", "date", *_r6("tmax_f", "tmin_f"), "humidity", "wind_mph"
    )


def listing_filter(spark: SparkSession, sf: str) -> DataFrame:
    markets = listings.parse_listings(fx.listings(spark, sf))
    return listings.weather_listings(markets, words=["high", "weather", "rain", "steel", "brass"])


def lake_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch(spark, "lake")
    lake.write_lake(features.build_features(fx.obs_daily(spark, sf)), path)
    columns = ["station", "date", "year", "tmax_f", "normal_30", "label_high"]
    return lake.read_lake(spark, path, columns=columns).select(
        "station", "date", "year", "tmax_f", r6("normal_30"), "label_high"
    )


def quote_decode(spark: SparkSession, sf: str) -> DataFrame:
    return quotes.decode_quotes(quotes.subscribe(fx.messages(spark, sf)))


def quote_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    rejected = quotes.quarantine(quotes.subscribe(fx.messages(spark, sf)))
    return rejected.select("seq", "topic_venue", "reason")


def quote_mid(spark: SparkSession, sf: str) -> DataFrame:
    priced = quotes.with_mid(fx.quotes(spark, sf))
    return priced.select("market", "venue", "seq", r6("yes_mid"))


def quote_encode(spark: SparkSession, sf: str) -> DataFrame:
    names = [f.name for f in schemas.QUOTE.fields]
    sent = quotes.encode(fx.quotes(spark, sf), columns=names)
    topic = F.concat(F.lit("book."), F.col("venue"))
    return quotes.decode_quotes(sent.select(topic.alias("topic"), "payload", "recv_ns"))


# --- features -----------------------------------------------------------------------


def lag_features(spark: SparkSession, sf: str) -> DataFrame:
    return features.lag_features(fx.obs_daily(spark, sf)).select(
        "station", "date", "tmax_lag1", "tmax_lag2", "tmax_lag3", "tmin_lag1",
        "humidity_lag1", "wind_lag1",
    )


def _normals(warmup: str):
    def query(spark: SparkSession, sf: str) -> DataFrame:
        built = features.build_features(fx.obs_daily(spark, sf), warmup)
        return built.select(
            "station", "date", *_r6("tmax_roll7", "tmax_roll30", "normal_30"), "target_high_f"
        )

    return query


def calendar_encoding(spark: SparkSession, sf: str) -> DataFrame:
    encoded = features.calendar_features(fx.obs_daily(spark, sf))
    return encoded.select(
        "station", "date", "doy", "month", "year", *_r6("doy_sin", "doy_cos")
    )


def contract_label(spark: SparkSession, sf: str) -> DataFrame:
    built = features.build_features(fx.obs_daily(spark, sf))
    return built.select("station", "date", "label_high", "threshold_f")


def contract_mixed_sources(spark: SparkSession, sf: str) -> DataFrame:
    """A primary without contract columns, a fallback that gives them on odd days only."""
    daily = fx.obs_daily(spark, sf)
    odd = F.dayofmonth("date") % 2 == 1
    given = daily.withColumns(
        {
            "label_high": F.when(odd, 1),
            "market_yes_price": F.when(odd, 0.25),
            "threshold_f": F.when(odd, 70.0),
        }
    )
    built = features.build_features(weather.choose_source(daily, given).drop("source"))
    return built.select("station", "date", "label_high", "threshold_f")


def _prices(pricing: str, noise: float):
    def query(spark: SparkSession, sf: str) -> DataFrame:
        built = features.build_features(fx.obs_daily(spark, sf), "full", pricing, noise)
        return built.select("station", "date", r6("market_yes_price"))

    return query


def _lake(spark: SparkSession, sf: str, pricing: str = "naive") -> DataFrame:
    """The stored feature lake, as the dataset operators find it in use."""
    path = scratch(spark, "lake")
    lake.write_lake(features.build_features(fx.obs_daily(spark, sf), pricing=pricing), path)
    return lake.read_lake(spark, path)


# --- dataset ------------------------------------------------------------------------


def sequence_windows(spark: SparkSession, sf: str) -> DataFrame:
    built = dataset.build_dataset(_lake(spark, sf))
    first, last = F.col("window")[0], F.element_at("window", -1)
    return built.select(
        "station",
        "date",
        "split",
        F.size("window").alias("steps"),
        first[0].alias("first_tmax"),
        last[0].alias("last_tmax"),
        last[2].alias("last_humidity"),
        "label",
        "high",
    )


def live_windows(spark: SparkSession, sf: str) -> DataFrame:
    live = dataset.live_windows(_lake(spark, sf))
    return live.select(
        "station",
        "date",
        F.size("window").alias("steps"),
        F.col("window")[0][0].alias("first_tmax"),
        "last_tmax_f",
        r6("avg_tmax_f"),
        "threshold_f",
        "market_yes_price",
    )


def time_split(spark: SparkSession, sf: str) -> DataFrame:
    daily = fx.obs_daily(spark, sf).select("station", "date")
    return dataset.time_split(daily)


def train_standardize(spark: SparkSession, sf: str) -> DataFrame:
    rows = _lake(spark, sf).select("station", "date", *models.FEATURES)
    return dataset.standardize(rows, dataset.train_statistics(rows)).select(
        "station", "date", *_r6(*models.FEATURES)
    )


def _summaries(spark: SparkSession, sf: str) -> DataFrame:
    rows = _lake(spark, sf)
    return dataset.window_summaries(rows, dataset.train_statistics(rows))


def window_summary_features(spark: SparkSession, sf: str) -> DataFrame:
    return _summaries(spark, sf).select("station", "date", "split", *_r6(*models.SUMMARY))


# --- models -------------------------------------------------------------------------


def logistic_scores(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch(spark, "summaries")
    _summaries(spark, sf).write.parquet(path)
    summaries = spark.read.parquet(path)
    scaled = models.scaled(summaries, dataset.summary_statistics(summaries), models.SUMMARY)
    model = models.fit_logistic(dataset.part(scaled, "train"), models.SUMMARY)
    return models.score_logistic(scaled, model, models.SUMMARY).select(
        "station", "date", "split", r6("lstm_prob")
    )


def sequence_scores(spark: SparkSession, sf: str) -> DataFrame:
    """Every window scored by its station's recurrent cell, learned from the train windows."""
    path = scratch(spark, "windows")
    rows = _lake(spark, sf)
    built = dataset.build_dataset(rows)
    dataset.standardize_windows(built, dataset.train_statistics(rows)).write.parquet(path)
    windows = spark.read.parquet(path)
    cell = recurrent.Cell(len(models.FEATURES))
    train = dataset.part(windows, "train")
    model = recurrent.fit_recurrent(train, cell.features, epochs=60, cell=cell)
    return recurrent.score_recurrent(windows, model, cell).select(
        "station", "date", "split", r6("lstm_prob")
    )


def pooled_logistic_scores(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch(spark, "summaries")
    _summaries(spark, sf).write.parquet(path)
    summaries = spark.read.parquet(path)
    model = models.fit_pooled_logistic(dataset.part(summaries, "train"), models.SUMMARY)
    return models.score_pooled_logistic(summaries, model).select(
        "station", "date", "split", r6("lstm_prob")
    )


def tree_scores(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch(spark, "windows")
    rows = _lake(spark, sf)
    built = dataset.build_dataset(rows)
    dataset.standardize_windows(built, dataset.train_statistics(rows)).write.parquet(path)
    windows = spark.read.parquet(path)
    model = models.fit_trees(dataset.part(windows, "train"))
    return models.score_trees(windows, model).select(
        "station", "date", "split", r6("transformer_prob")
    )


def warm_scorer(x: np.ndarray) -> np.ndarray:
    """A small model "trained elsewhere": mean high less 0.8 of the last low."""
    return 1.0 / (1.0 + np.exp(-(0.05 * x[:, :, 0].mean(axis=1) - 0.04 * x[:, -1, 1] - 2.0)))


def external_model_scores(spark: SparkSession, sf: str) -> DataFrame:
    windows = dataset.build_dataset(_lake(spark, sf)).select("station", "date", "window")
    return models.score_external(windows, warm_scorer).select(
        "station", "date", r6("external_prob")
    )


def blend_probs(spark: SparkSession, sf: str) -> DataFrame:
    mixed = models.blend_members(fx.preds(spark, sf), 0.7)
    return mixed.select("market", "date", r6("ensemble_prob"))


def model_accuracy(spark: SparkSession, sf: str) -> DataFrame:
    mixed = models.blend_members(fx.preds(spark, sf))
    probs = ["lstm_prob", "transformer_prob", "ensemble_prob"]
    report = models.accuracy(mixed, probs, "outcome", ["market"])
    return report.select(
        "market", *_r6("accuracy_lstm", "accuracy_transformer", "accuracy_ensemble")
    )


def calibrated_probs(spark: SparkSession, sf: str) -> DataFrame:
    rows = fx.preds(spark, sf).withColumn("model_prob", F.col("lstm_prob"))
    fitted = calibrate.fit_platt(rows)
    return calibrate.apply_platt(rows, fitted).select("market", "date", r6("model_prob"))


def calibrated_null_market(spark: SparkSession, sf: str) -> DataFrame:
    """Calibration where the rows of one market have no market name."""
    rows = _nameless(fx.preds(spark, sf)).select("market", "date", F.col("lstm_prob").alias("model_prob"), "outcome")
    fitted = calibrate.fit_platt(rows)
    return calibrate.apply_platt(rows, fitted).select("market", "date", r6("model_prob"))


def _nameless(preds: DataFrame) -> DataFrame:
    return preds.withColumn("market", F.when(F.col("market") != "HUB", F.col("market")))


def calibrated_overconfident(spark: SparkSession, sf: str) -> DataFrame:
    """Members eight times too sure, for which a full Newton step overshoots."""
    rows = fx.preds(spark, sf).withColumn(
        "model_prob", sigmoid(F.lit(8.0) * logit(F.col("lstm_prob")))
    )
    fitted = calibrate.fit_platt(rows)
    return calibrate.apply_platt(rows, fitted).select("market", "date", r6("model_prob"))


# --- strategy and backtest ----------------------------------------------------------


def _preds(spark: SparkSession, sf: str) -> DataFrame:
    return models.blend_members(fx.preds(spark, sf), 0.5, "model_prob").select(
        "market", "date", "model_prob", "market_prob", "outcome"
    )


def trade_decisions(spark: SparkSession, sf: str) -> DataFrame:
    decided = backtest.decisions(_preds(spark, sf))
    return decided.select("market", "date", "side", *_r6("edge", "fair_yes_price"))


def kelly_sizing(spark: SparkSession, sf: str) -> DataFrame:
    sized = backtest.sizing(backtest.decisions(_preds(spark, sf)))
    return sized.select("market", "date", "side", *_r6("kelly_full", "kelly_used"), "stake_usd")


def trade_pnl(spark: SparkSession, sf: str) -> DataFrame:
    traded = backtest.trades(_preds(spark, sf))
    return traded.select("market", "date", "taken", "won", r6("pnl"))


def equity_curve(spark: SparkSession, sf: str) -> DataFrame:
    curve = backtest.equity(backtest.trades(_preds(spark, sf)))
    return curve.select("market", "date", "equity", r6("daily_return"))


def drawdown(spark: SparkSession, sf: str) -> DataFrame:
    curve = backtest.equity(backtest.trades(_preds(spark, sf)))
    return curve.select("market", "date", "peak", r6("drawdown"))


_METRICS = ["avg_edge", "hit_rate", "monthly_roi", "total_return", "max_drawdown", "sharpe"]


def equity_view(spark: SparkSession, sf: str) -> DataFrame:
    _, curve = backtest.run_backtest(_preds(spark, sf))
    written = curve.withColumn("date", F.date_format("date", "yyyy-MM-dd"))
    return serving.equity_view(written)


def backtest_metrics(spark: SparkSession, sf: str) -> DataFrame:
    metrics, _ = backtest.run_backtest(_preds(spark, sf))
    return metrics.select(
        "market", "n_trades", *_r6(*_METRICS), "final_bankroll", "window_start", "window_end"
    )


def _validation(spark: SparkSession, sf: str) -> DataFrame:
    split = dataset.time_split(fx.preds(spark, sf), ["market"])
    return dataset.part(split, "val").drop("split")


def grid_search_scores(spark: SparkSession, sf: str) -> DataFrame:
    scores = search.score_candidates(_validation(spark, sf), search.grid())
    return scores.select(
        "market",
        *_r6("weight", "threshold"),
        "n_trades",
        *_r6("total_return", "max_drawdown", "score"),
    )


def grid_search_best(spark: SparkSession, sf: str) -> DataFrame:
    best = search.grid_search(_validation(spark, sf))
    return best.select(
        "market", *_r6("weight_lstm", "edge_threshold", "score"), "opt_method"
    )


def refined_search(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch(spark, "validation")
    _validation(spark, sf).write.parquet(path)
    best = search.refined_search(spark.read.parquet(path))
    return best.select(
        "market", *_r6("weight_lstm", "edge_threshold", "score"), "opt_method"
    )


def adaptive_search(spark: SparkSession, sf: str) -> DataFrame:
    """Best of 40 adaptive trials of each market."""
    path = scratch(spark, "validation")
    _validation(spark, sf).write.parquet(path)
    best = adaptive.adaptive_search(spark.read.parquet(path))
    return best.select(
        "market", *_r6("weight_lstm", "edge_threshold", "score"), "opt_method"
    )


# --- forecast -----------------------------------------------------------------------


def point_forecast(spark: SparkSession, sf: str) -> DataFrame:
    p = (F.col("lstm_prob") - 0.2) / 0.6
    return fx.preds(spark, sf).select(
        "market",
        F.date_add("date", 1).alias("target_date"),
        r6(point_estimate(p, F.lit(70.0)), "predicted_high_f"),
        percent(F.col("market_prob"), 1).alias("market_pct"),
    )


def _scored(spark: SparkSession, sf: str) -> DataFrame:
    newest = serving.latest_by_key(fx.preds(spark, sf), ["market"], ["date"])
    return models.blend_members(newest).select(
        "market",
        F.col("market").alias("station"),
        "date",
        "lstm_prob",
        "transformer_prob",
        "ensemble_prob",
        F.lit(70.5).alias("threshold_f"),
        F.col("market_prob").alias("market_yes_price"),
        F.lit(0.02).alias("edge_threshold"),
    )


def live_records(spark: SparkSession, sf: str) -> DataFrame:
    records, odds, sizes = forecast.live_messages(_scored(spark, sf), 0)
    joined = serving.forecast_view(records, odds, sizes)
    return joined.select(
        "market", "target_date", "lstm_prob", "ensemble_prob", "predicted_high_f",
        "market_prob", "odds_edge", "side", "edge", "kelly_fraction_full",
        "kelly_fraction_used", "stake_usd", "edge_pct",
    )


def _study(spark: SparkSession, sf: str) -> tuple[DataFrame, forecast.Study]:
    rows = _lake(spark, sf, "informed")
    return rows, forecast.run_study(spark, rows)


def live_forecast(spark: SparkSession, sf: str) -> DataFrame:
    rows, study = _study(spark, sf)
    scored = forecast.live_probabilities(rows, study.fitted)
    records, odds, sizes = forecast.live_messages(scored, 0)
    return serving.forecast_view(records, odds, sizes)


def market_study(spark: SparkSession, sf: str) -> DataFrame:
    _, study = _study(spark, sf)
    report = study.metrics.join(study.accuracy, "market")
    return serving.backtest_view(report).drop("backends")


# --- quote monitor ------------------------------------------------------------------


def book_carry_forward(spark: SparkSession, sf: str) -> DataFrame:
    state = book.book_state(fx.quotes(spark, sf), fx.VENUES)
    return state.select(
        "market", "seq", *_r6("best_ask", "best_bid"), "ask_venue", "bid_venue", "venue_count"
    )


def _signal_columns(signals: DataFrame) -> DataFrame:
    return signals.select(
        "market", "buy_venue", "sell_venue", *_r6("buy_price", "sell_price", "spread_pct"),
        "latency_us", "ts_ns", "seq",
    )


def arb_signals(spark: SparkSession, sf: str) -> DataFrame:
    return _signal_columns(book.arb_signals(fx.quotes(spark, sf), fx.VENUES))


def arb_nanosecond_seq(spark: SparkSession, sf: str) -> DataFrame:
    """Quotes numbered by nanoseconds, all in blocks of about 500 rows."""
    quotes = fx.quotes(spark, sf).withColumn("seq", F.col("seq") * 1_000_003 + 1_700_000_000_000_000_000)
    return _signal_columns(book.arb_signals(quotes, rows=500))


def arb_signals_bucketed(spark: SparkSession, sf: str) -> DataFrame:
    """Small blocks and venues found in the data."""
    found = book.arb_signals(fx.quotes(spark, sf), block=seq_blocks(size=500))
    return _signal_columns(found)


def asof_forecast(spark: SparkSession, sf: str) -> DataFrame:
    sent = fx.quotes(spark, sf)
    published = sent.where(F.col("venue") == "signup").select(
        "market",
        (F.col("ts_ns") + 1_000_000_000).alias("ts_ns"),
        ((F.col("seq") % 997) / 997.0).alias("ensemble_prob"),
        (F.col("seq") + 1).alias("version"),
    )
    seen = book.asof_forecast(sent, published, ["ensemble_prob", "version"])
    return seen.select("market", "seq", r6("ensemble_prob"), "version")


def latest_quote(spark: SparkSession, sf: str) -> DataFrame:
    newest = serving.latest_by_key(fx.quotes(spark, sf), ["market", "venue"], ["seq"])
    return newest.select("market", "venue", "seq", "ts_ns", *_r6("yes_bid", "yes_ask"))


def _capped(spark: SparkSession, sf: str) -> DataFrame:
    signals = book.arb_signals(fx.quotes(spark, sf), fx.VENUES)
    return serving.capped_list(signals, ["market"], ["ts_ns", "seq"])


def capped_signals(spark: SparkSession, sf: str) -> DataFrame:
    return _capped(spark, sf).select("market", "place", "seq", "ts_ns", r6("spread_pct"))


def newest_decoded(spark: SparkSession, sf: str) -> DataFrame:
    """Capped lists of raw payloads, read back: bad payloads use up a place."""
    kept = serving.capped_list(fx.messages(spark, sf), ["topic"], ["seq"], 100)
    decoded = serving.read_newest(kept.withColumnRenamed("seq", "sent"), schemas.QUOTE, 60)
    return decoded.select("topic", "place", "sent", "market", r6("yes_bid"))


def point_read(spark: SparkSession, sf: str) -> DataFrame:
    sent = fx.messages(spark, sf)
    store = sent.select(F.concat_ws(":", F.lit("q"), "seq").alias("key"), "payload")
    wanted = sent.select(F.concat_ws(":", F.lit("q"), F.col("seq") * 2).alias("key"))
    found = serving.point_read(wanted, store, schemas.QUOTE, {"market": "?", "yes_bid": -1.0})
    return found.select("key", "market", r6("yes_bid"))


def signal_view(spark: SparkSession, sf: str) -> DataFrame:
    view = serving.signal_view(book.arb_signals(fx.quotes(spark, sf), fx.VENUES))
    return view.select(
        "market", "buy_venue", "sell_venue", *_r6("buy_price", "sell_price"),
        F.col("`spread_%`").alias("spread_percent"), "latency_us",
    )


def venue_quotes(spark: SparkSession, sf: str) -> DataFrame:
    latest = serving.latest_by_key(fx.quotes(spark, sf), ["venue"], ["seq"])
    # Of the venues in the events one is listed under a name that never quotes.
    name = F.col("event_type")
    listed = fx.table(spark, sf, "events").select(
        F.when(name == "view", "nowhere").otherwise(name).alias("venue")
    )
    return serving.venue_quotes(latest, listed).select("venue", "market", "seq", r6("yes_bid"))


# --- engine statistics --------------------------------------------------------------


def _events(spark: SparkSession, sf: str) -> DataFrame:
    return book.arb_events(fx.quotes(spark, sf), fx.VENUES)


def latency_percentiles(spark: SparkSession, sf: str) -> DataFrame:
    return monitor.latency_percentiles(fx.quotes(spark, sf))


def latency_percentiles_approx(spark: SparkSession, sf: str) -> DataFrame:
    return monitor.latency_percentiles_approx(fx.quotes(spark, sf))


def rolling_latency(spark: SparkSession, sf: str) -> DataFrame:
    return monitor.rolling_latency(fx.quotes(spark, sf), HOUR_NS)


def rolling_latency_ring(spark: SparkSession, sf: str) -> DataFrame:
    return monitor.rolling_latency(fx.quotes(spark, sf), HOUR_NS, samples=256)


def second_spine_counts(spark: SparkSession, sf: str) -> DataFrame:
    counts = monitor.tick_counts(_events(spark, sf), HOUR_NS, F.col("is_signal"))
    return monitor.with_silent_ticks(counts).select(
        "market", "tick", "messages", "signals", "samples"
    )


def availability(spark: SparkSession, sf: str) -> DataFrame:
    counts = monitor.tick_counts(fx.quotes(spark, sf), HOUR_NS // 4)
    stats = monitor.running_stats(counts, HOUR_NS // 4)
    return stats.select("market", "tick", "messages_processed", r6("uptime_pct"))


def _stats(spark: SparkSession, sf: str) -> DataFrame:
    return monitor.engine_stats(fx.quotes(spark, sf), fx.VENUES, HOUR_NS)


_STATS = ["uptime_seconds", "latency_us_p50", "latency_us_p99", "msgs_per_sec", "uptime_pct"]
_COUNTERS = ["messages_processed", "arb_opportunities", "trades_executed"]


def engine_stats(spark: SparkSession, sf: str) -> DataFrame:
    return _stats(spark, sf).select("market", "tick", "started_at_ns", *_COUNTERS, *_r6(*_STATS))


def health_view(spark: SparkSession, sf: str) -> DataFrame:
    return serving.health_view(_stats(spark, sf)).select(
        "market", "tick", *_COUNTERS, *_r6("latency_us_p99", "uptime_pct")
    )


# --- streams ------------------------------------------------------------------------


def _land(spark: SparkSession, sf: str, parts: int = 4):
    """Write the quotes to a landing folder part by part; yields after each part."""
    folder = scratch(spark, "landing")
    sent = fx.quotes(spark, sf)
    low, high = sent.agg(F.min("seq"), F.max("seq")).first()
    step = (high - low) // parts + 1
    for i in range(parts):
        slice_ = F.col("seq").between(low + i * step, low + (i + 1) * step - 1)
        sent.where(slice_).write.mode("append").parquet(folder)
        yield quotes.message_stream(spark, folder, "parquet", sent.schema)


def stream_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Counts per hour the watermark has closed, from a stream resumed after each part."""
    out, checkpoint = scratch(spark, "ticks"), scratch(spark, "checkpoint")
    for landed in _land(spark, sf):
        ticks = streams.tick_stream(landed, "1 hour", "1 hour")
        streams.append_table(ticks, out, checkpoint, availableNow=True).awaitTermination()
    return spark.read.parquet(out)


def stream_counts_all(spark: SparkSession, sf: str) -> DataFrame:
    """Counts of every hour, open or closed, from a stream resumed after each part."""
    ticks = streams.TickTable(scratch(spark, "tick-table"), HOUR_NS)
    for landed in _land(spark, sf):
        ticks.start(landed, availableNow=True).awaitTermination()
    return ticks.ticks(spark)


def stream_arb(spark: SparkSession, sf: str) -> DataFrame:
    monitor_ = streams.ArbStream(scratch(spark, "arb"), fx.VENUES)
    for landed in _land(spark, sf):
        monitor_.start(landed, availableNow=True).awaitTermination()
    return _signal_columns(monitor_.signals(spark))


def stream_signal_feed(spark: SparkSession, sf: str) -> DataFrame:
    """The newest 200 signals of each market, kept up batch by batch."""
    monitor_ = streams.ArbStream(scratch(spark, "arb"), fx.VENUES)
    for landed in _land(spark, sf):
        monitor_.start(landed, availableNow=True).awaitTermination()
    return _signal_columns(monitor_.feed(spark))


def stream_engine_stats(spark: SparkSession, sf: str) -> DataFrame:
    """Stats records from the tables that both streams of the monitor keep."""
    arb = streams.ArbStream(scratch(spark, "arb"), fx.VENUES)
    ticks = streams.TickTable(scratch(spark, "tick-table"), HOUR_NS)
    for landed in _land(spark, sf):
        running = [table.start(landed, availableNow=True) for table in (arb, ticks)]
        for query in running:
            query.awaitTermination()
    records = ticks.engine_stats(spark, arb.signals(spark))
    return records.select("market", "tick", "started_at_ns", *_COUNTERS, *_r6(*_STATS))


def stream_latest(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch(spark, "latest")
    sink = tables.latest_sink(f"{path}/table", ["market", "venue"], ["seq"])
    for landed in _land(spark, sf):
        writer = landed.writeStream.foreachBatch(sink)
        writer = writer.option("checkpointLocation", f"{path}/checkpoint")
        writer.trigger(availableNow=True).start().awaitTermination()
    newest = tables.current(spark, f"{path}/table")
    return newest.select("market", "venue", "seq", "ts_ns", *_r6("yes_bid", "yes_ask"))


def stream_capped(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch(spark, "capped")
    sink = tables.capped_sink(f"{path}/table", ["market"], ["seq"], 50)
    for landed in _land(spark, sf):
        writer = landed.writeStream.foreachBatch(sink)
        writer = writer.option("checkpointLocation", f"{path}/checkpoint")
        writer.trigger(availableNow=True).start().awaitTermination()
    return tables.current(spark, f"{path}/table").select("market", "venue", "seq")


QUERIES = {
    "observations_wide": observations_wide,
    "source_gate": source_gate,
    "station_lookup": station_lookup,
    "backfill_chunks": backfill_chunks,
    "backfill_resumed": backfill_resumed,
    "listing_filter": listing_filter,
    "lake_roundtrip": lake_roundtrip,
    "quote_decode": quote_decode,
    "quote_quarantine": quote_quarantine,
    "quote_mid": quote_mid,
    "quote_encode": quote_encode,
    "lag_features": lag_features,
    "rolling_normals_partial": _normals("partial"),
    "rolling_normals_full": _normals("full"),
    "calendar_encoding": calendar_encoding,
    "contract_label": contract_label,
    "contract_mixed_sources": contract_mixed_sources,
    "price_naive": _prices("naive", 0.0),
    "price_informed": _prices("informed", 0.0),
    "price_informed_noise": _prices("informed", 0.02),
    "sequence_windows": sequence_windows,
    "live_windows": live_windows,
    "time_split": time_split,
    "train_standardize": train_standardize,
    "window_summary_features": window_summary_features,
    "logistic_scores": logistic_scores,
    "sequence_scores": sequence_scores,
    "pooled_logistic_scores": pooled_logistic_scores,
    "tree_scores": tree_scores,
    "external_model_scores": external_model_scores,
    "blend_probs": blend_probs,
    "model_accuracy": model_accuracy,
    "calibrated_probs": calibrated_probs,
    "calibrated_null_market": calibrated_null_market,
    "calibrated_overconfident": calibrated_overconfident,
    "trade_decisions": trade_decisions,
    "kelly_sizing": kelly_sizing,
    "trade_pnl": trade_pnl,
    "equity_curve": equity_curve,
    "drawdown": drawdown,
    "equity_view": equity_view,
    "backtest_metrics": backtest_metrics,
    "grid_search_scores": grid_search_scores,
    "grid_search_best": grid_search_best,
    "refined_search": refined_search,
    "adaptive_search": adaptive_search,
    "point_forecast": point_forecast,
    "live_records": live_records,
    "live_forecast": live_forecast,
    "market_study": market_study,
    "book_carry_forward": book_carry_forward,
    "arb_signals": arb_signals,
    "arb_signals_bucketed": arb_signals_bucketed,
    "arb_nanosecond_seq": arb_nanosecond_seq,
    "asof_forecast": asof_forecast,
    "latest_quote": latest_quote,
    "capped_signals": capped_signals,
    "newest_decoded": newest_decoded,
    "point_read": point_read,
    "signal_view": signal_view,
    "venue_quotes": venue_quotes,
    "latency_percentiles": latency_percentiles,
    "latency_percentiles_approx": latency_percentiles_approx,
    "rolling_latency": rolling_latency,
    "rolling_latency_ring": rolling_latency_ring,
    "second_spine_counts": second_spine_counts,
    "availability": availability,
    "engine_stats": engine_stats,
    "health_view": health_view,
    "stream_counts": stream_counts,
    "stream_counts_all": stream_counts_all,
    "stream_arb": stream_arb,
    "stream_signal_feed": stream_signal_feed,
    "stream_engine_stats": stream_engine_stats,
    "stream_latest": stream_latest,
    "stream_capped": stream_capped,
}
