"""The study of all markets: train, search, calibrate, backtest, and the live forecast."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from edgeframe.defaults import BANKROLL_USD, KELLY_CAP, KELLY_FRACTION
from edgeframe.functions import contracts
from edgeframe.functions.numeric import point_estimate
from edgeframe.operators import adaptive, backtest, calibrate, dataset, models, search
from edgeframe.sources import lake as lake_io
from edgeframe.storage import scratch


@dataclass
class Fitted:
    """Everything needed to score a station: statistics, both members, parameters."""

    statistics: DataFrame
    summary_statistics: DataFrame
    logistic: DataFrame
    trees: PipelineModel
    best: DataFrame | None = None
    platt: DataFrame | None = None


@dataclass
class Study:
    fitted: Fitted
    metrics: DataFrame
    equity: DataFrame
    accuracy: DataFrame


def _stored(df: DataFrame, folder: str, name: str) -> DataFrame:
    """``df`` written to the run's folder and read back: later steps start from the file."""
    df.write.mode("overwrite").parquet(f"{folder}/{name}")
    return df.sparkSession.read.parquet(f"{folder}/{name}")


def fit_members(lake: DataFrame, folder: str) -> tuple[Fitted, DataFrame]:
    """Train both members; return them and the members' probabilities on val and test."""
    statistics = _stored(dataset.train_statistics(lake), folder, "statistics")
    summaries = _stored(dataset.window_summaries(lake, statistics), folder, "summaries")
    windows = dataset.standardize_windows(dataset.build_dataset(lake), statistics)
    windows = _stored(windows, folder, "windows")
    summary_stats = _stored(dataset.summary_statistics(summaries), folder, "summary_statistics")
    scaled = models.scaled(summaries, summary_stats, models.SUMMARY)
    logistic = models.fit_logistic(dataset.part(scaled, "train"), models.SUMMARY)
    logistic = _stored(logistic, folder, "logistic")
    trees = models.fit_trees(dataset.part(windows, "train"))
    models.save_model(trees, f"{folder}/trees")
    fitted = Fitted(statistics, summary_stats, logistic, trees)

    held_out = F.col("split") != "train"
    a = models.score_logistic(scaled.where(held_out), logistic, models.SUMMARY)
    b = models.score_trees(windows.where(held_out), trees)
    preds = a.join(b.select("station", "date", "transformer_prob"), ["station", "date"]).select(
        F.col("station").alias("market"),
        "date",
        "split",
        "lstm_prob",
        "transformer_prob",
        F.col("market_yes_price").alias("market_prob"),
        F.col("label").alias("outcome"),
    )
    return fitted, _stored(preds, folder, "predictions")


def run_study(
    spark: SparkSession, lake: DataFrame, out: str | None = None, method: str = "grid-search"
) -> Study:
    """Train, tune on validation, calibrate on validation, backtest on test.

    The search scores uncalibrated probabilities; calibration is fitted afterwards.
    """
    folder = out or scratch(spark, "study")
    log = f"{folder}/status"
    lake_io.log_status(spark, log, "training", "both members")
    fitted, preds = fit_members(lake, folder)
    val, test = dataset.part(preds, "val"), dataset.part(preds, "test")

    lake_io.log_status(spark, log, "optimizing", method)
    find = {
        "grid-search": search.grid_search,
        "grid-refine": search.refined_search,
        "adaptive": adaptive.adaptive_search,
    }[method]
    fitted.best = _stored(find(val), folder, "best")

    def blended(part: DataFrame) -> DataFrame:
        tuned = part.join(fitted.best.select("market", "weight_lstm"), "market")
        return models.blend_members(tuned, F.col("weight_lstm"), "model_prob")

    fitted.platt = _stored(calibrate.fit_platt(blended(val)), folder, "platt")
    lake_io.log_status(spark, log, "backtesting")
    ready = calibrate.apply_platt(blended(test), fitted.platt).join(
        fitted.best.select("market", "edge_threshold"), "market"
    )
    traded = backtest.trades(ready, F.col("edge_threshold"))
    # One backtest: the metrics are read off the stored curve.
    curve = _stored(backtest.equity(traded), folder, "curve")
    metrics, equity = backtest.metrics(curve), curve.select("market", "date", "equity")
    metadata = fitted.best.drop("score").withColumn("backends", models.backends())
    lake_io.save_backtest(metrics, equity, metadata, f"{folder}/backtest")
    accuracy = models.accuracy(
        models.blend_members(val),
        ["lstm_prob", "transformer_prob", "ensemble_prob"],
        "outcome",
        ["market"],
    )
    return Study(
        fitted,
        spark.read.parquet(f"{folder}/backtest/metrics"),
        spark.read.parquet(f"{folder}/backtest/equity").drop("year"),
        accuracy,
    )


def live_probabilities(lake: DataFrame, fitted: Fitted) -> DataFrame:
    """Both members, blended and calibrated, on the newest window of each station."""
    live = dataset.live_windows(lake)
    windows = dataset.standardize_windows(live, fitted.statistics)
    summaries = dataset.scale_summaries(windows, fitted.statistics)
    scaled = models.scaled(summaries, fitted.summary_statistics, models.SUMMARY)
    scored = models.score_logistic(scaled, fitted.logistic, models.SUMMARY)
    scored = models.score_trees(scored, fitted.trees)
    named = scored.withColumn("market", F.col("station"))
    tuned = named.join(fitted.best.select("market", "weight_lstm", "edge_threshold"), "market")
    raw = models.blend_members(tuned, F.col("weight_lstm"))
    return calibrate.apply_platt(raw, fitted.platt, "ensemble_prob")


def live_messages(
    scored: DataFrame,
    ts_ns: int,
    safety: float = KELLY_FRACTION,
    cap: float = KELLY_CAP,
    bankroll: float = BANKROLL_USD,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(forecast, odds, sizing) records for the day after the newest one.

    ``scored`` holds market, station, date, both member probabilities, ensemble_prob,
    threshold_f, market_yes_price and edge_threshold.
    """
    priced = scored.withColumns(
        {
            "model_prob": F.col("ensemble_prob"),
            "market_prob": F.col("market_yes_price"),
            "ts_ns": F.lit(ts_ns).cast("long"),
        }
    )
    sized = backtest.sizing(
        backtest.decisions(priced, F.col("edge_threshold")), safety, cap, bankroll
    )
    p, q = F.col("model_prob"), F.col("market_prob")
    forecast = sized.select(
        F.col("station").alias("city"),
        "market",
        F.date_format(F.date_add("date", 1), "yyyy-MM-dd").alias("target_date"),
        "threshold_f",
        F.round("lstm_prob", 4).alias("lstm_prob"),
        F.round("transformer_prob", 4).alias("transformer_prob"),
        F.round("ensemble_prob", 4).alias("ensemble_prob"),
        F.round(point_estimate(p, F.col("threshold_f")), 1).alias("predicted_high_f"),
        "ts_ns",
    )
    odds = sized.select(
        "market",
        F.round(p, 4).alias("model_prob"),
        F.round(q, 4).alias("market_prob"),
        F.round(p - q, 4).alias("edge"),
        F.round(p, 4).alias("fair_yes_price"),
        "ts_ns",
    )
    sizes = sized.select(
        "market",
        "side",
        F.round("edge", 4).alias("edge"),
        F.round("kelly_full", 4).alias("kelly_fraction_full"),
        F.round("kelly_used", 4).alias("kelly_fraction_used"),
        "stake_usd",
        F.lit(float(bankroll)).alias("bankroll_usd"),
        "ts_ns",
    )
    return forecast, odds, sizes


def publish_live(
    lake: DataFrame, fitted: Fitted, ts_ns: int, path: str
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Append the live records to their tables; "latest" is a read-side view over them."""
    folder = scratch(lake.sparkSession, "live")
    scored = _stored(live_probabilities(lake, fitted), folder, "scored")
    messages = live_messages(scored, ts_ns)
    for name, table in zip(("forecast", "odds", "sizing"), messages):
        table.write.mode("append").parquet(f"{path}/{name}")
    return messages
