"""Supervised dataset: past-only windows, time-ordered split, train-only statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from edgeframe.defaults import FEATURES, SEQ_LEN, TEST_FRAC, VAL_FRAC
from edgeframe.operators.blocks import (
    BLOCK,
    block_counts,
    day_blocks,
    in_block,
    newest,
    positions,
    with_history,
)

KEY, ORDER = ["station"], ["date"]


def split_column(
    place: Column, n: Column, val_frac: float = VAL_FRAC, test_frac: float = TEST_FRAC
) -> Column:
    """train, val or test by 0-based place among ``n``; val and test get at least one."""
    n_test = F.greatest(F.lit(1), F.floor(n * F.lit(test_frac)))
    n_val = F.greatest(F.lit(1), F.floor(n * F.lit(val_frac)))
    return (
        F.when(place < n - n_test - n_val, "train").when(place < n - n_test, "val").otherwise("test")
    )


def time_split(
    df: DataFrame,
    keys: Sequence[str] = KEY,
    val_frac: float = VAL_FRAC,
    test_frac: float = TEST_FRAC,
    block: Column | None = None,
) -> DataFrame:
    """Add ``split`` by the position of a row in its key's time order."""
    rows = df.withColumn(BLOCK, day_blocks() if block is None else block)
    placed = positions(rows, keys, ORDER)
    return placed.withColumn(
        "split", split_column(F.col("_pos"), F.col("_total"), val_frac, test_frac)
    ).drop(BLOCK, "_pos", "_total")


def _past(
    lake: DataFrame,
    added: dict[str, Column],
    seq_len: int,
    block: Column,
    val_frac: float,
    test_frac: float,
) -> DataFrame:
    """Rows with a full window before them, with window columns, ``_pos`` and ``split``.

    One shuffle by (station, block) serves the window and the position.
    """
    rows = lake.withColumn(BLOCK, block)
    counts = block_counts(rows, KEY).drop("_cnt")
    own = F.sum((~F.col("_seed")).cast("long")).over(in_block(KEY, ORDER))
    placed = (
        with_history(rows, KEY, ORDER, seq_len)
        .withColumns({**added, "_at": own})
        .where(~F.col("_seed"))
        .join(counts, [*KEY, BLOCK])
        .withColumn("_pos", F.col("_before") + F.col("_at") - 1)
        .where((F.col("_pos") >= seq_len) & (F.col("_total") - seq_len >= 3))
    )
    split = split_column(
        F.col("_pos") - seq_len, F.col("_total") - seq_len, val_frac, test_frac
    )
    return placed.withColumn("split", split).drop(BLOCK, "_seed", "_at", "_before", "_total")


def build_dataset(
    lake: DataFrame,
    seq_len: int = SEQ_LEN,
    val_frac: float = VAL_FRAC,
    test_frac: float = TEST_FRAC,
    features: Sequence[str] = FEATURES,
    block: Column | None = None,
) -> DataFrame:
    """One row per forecastable day: ``window`` (the previous rows), label, price, high, split.

    Stations with fewer than three windows cannot be split and are left out; see
    ``short_stations``.
    """
    frame = in_block(KEY, ORDER).rowsBetween(-seq_len, -1)
    window = F.collect_list(F.array(*features)).over(frame)
    rows = _past(
        lake, {"window": window}, seq_len, day_blocks() if block is None else block,
        val_frac, test_frac,
    )
    return rows.select(
        *KEY,
        *ORDER,
        "split",
        "window",
        F.col("label_high").alias("label"),
        "market_yes_price",
        F.col("tmax_f").alias("high"),
        "threshold_f",
    )


def short_stations(lake: DataFrame, seq_len: int = SEQ_LEN) -> DataFrame:
    """Stations with too few rows for a dataset."""
    return lake.groupBy(*KEY).count().where(F.col("count") < seq_len + 3)


def part(dataset: DataFrame, split: str) -> DataFrame:
    return dataset.where(F.col("split") == split)


def train_statistics(
    lake: DataFrame,
    seq_len: int = SEQ_LEN,
    val_frac: float = VAL_FRAC,
    test_frac: float = TEST_FRAC,
    features: Sequence[str] = FEATURES,
    block: Column | None = None,
) -> DataFrame:
    """Mean and deviation of each feature over the train windows of a station.

    A row counts once per train window holding it. The number of those windows follows
    from its position, so no window is built.
    """
    rows = positions(
        lake.withColumn(BLOCK, day_blocks() if block is None else block), KEY, ORDER
    )
    n = F.col("_total") - seq_len
    train = n - F.greatest(F.lit(1), F.floor(n * test_frac)) - F.greatest(
        F.lit(1), F.floor(n * val_frac)
    )
    # Window i (i = seq_len ... seq_len + train - 1) holds rows i - seq_len ... i - 1.
    first = F.greatest(F.col("_pos") + 1, F.lit(seq_len))
    last = F.least(F.col("_pos") + seq_len, F.lit(seq_len - 1) + train)
    weight = F.greatest(F.lit(0), last - first + 1).cast("double")
    weighted = rows.withColumn("_w", weight).where(F.col("_w") > 0)
    sums = weighted.groupBy(*KEY).agg(
        F.sum("_w").alias("_w"),
        *[F.sum(F.col("_w") * F.col(f)).alias(f"_s_{f}") for f in features],
        *[F.sum(F.col("_w") * F.col(f) * F.col(f)).alias(f"_q_{f}") for f in features],
    )
    means = {f: F.col(f"_s_{f}") / F.col("_w") for f in features}
    return sums.select(
        *KEY,
        *[means[f].alias(f"mean_{f}") for f in features],
        *[
            (
                F.sqrt(
                    F.greatest(F.col(f"_q_{f}") / F.col("_w") - means[f] * means[f], F.lit(0.0))
                )
                + F.lit(1e-6)
            ).alias(f"std_{f}")
            for f in features
        ],
    )


def standardize(
    df: DataFrame, statistics: DataFrame, features: Sequence[str] = FEATURES
) -> DataFrame:
    """Replace each feature by its distance from the train mean in deviations."""
    joined = df.join(statistics, KEY)
    return joined.withColumns(
        {f: (F.col(f) - F.col(f"mean_{f}")) / F.col(f"std_{f}") for f in features}
    ).select(*df.columns)


def standardize_windows(
    dataset: DataFrame, statistics: DataFrame, features: Sequence[str] = FEATURES
) -> DataFrame:
    """Standardise the ``window`` column; inputs of the window learners."""
    mean = F.array(*[F.col(f"mean_{f}") for f in features])
    std = F.array(*[F.col(f"std_{f}") for f in features])

    def scaled(step: Column) -> Column:
        centred = F.zip_with(step, F.col("_mean"), lambda x, m: x - m)
        return F.zip_with(centred, F.col("_std"), lambda x, s: x / s)

    joined = dataset.join(
        statistics.select(*KEY, mean.alias("_mean"), std.alias("_std")), KEY
    )
    return joined.withColumn("window", F.transform("window", scaled)).select(*dataset.columns)


def summary_names(features: Sequence[str] = FEATURES) -> list[str]:
    return [f"avg_{f}" for f in features] + [f"last_{f}" for f in features]


def window_summaries(
    lake: DataFrame,
    statistics: DataFrame,
    seq_len: int = SEQ_LEN,
    val_frac: float = VAL_FRAC,
    test_frac: float = TEST_FRAC,
    features: Sequence[str] = FEATURES,
    block: Column | None = None,
) -> DataFrame:
    """Mean and last step of each standardised window, without building the windows."""
    w = in_block(KEY, ORDER)
    added = {f"avg_{f}": F.avg(f).over(w.rowsBetween(-seq_len, -1)) for f in features}
    added |= {f"last_{f}": F.lag(f, 1).over(w) for f in features}
    rows = _past(
        lake, added, seq_len, day_blocks() if block is None else block, val_frac, test_frac
    )
    kept = rows.select(
        *KEY,
        *ORDER,
        "split",
        *summary_names(features),
        F.col("label_high").alias("label"),
        "market_yes_price",
        F.col("tmax_f").alias("high"),
        "threshold_f",
    )
    return scale_summaries(kept, statistics, features)


def scale_summaries(
    summaries: DataFrame, statistics: DataFrame, features: Sequence[str] = FEATURES
) -> DataFrame:
    joined = summaries.join(statistics, KEY)
    return joined.withColumns(
        {
            f"{kind}_{f}": (F.col(f"{kind}_{f}") - F.col(f"mean_{f}")) / F.col(f"std_{f}")
            for kind in ("avg", "last")
            for f in features
        }
    ).select(*summaries.columns)


def summary_statistics(
    summaries: DataFrame, features: Sequence[str] = FEATURES
) -> DataFrame:
    """Mean and deviation of the summary columns over the train rows of a station."""
    names = summary_names(features)
    return part(summaries, "train").groupBy(*KEY).agg(
        *[F.avg(n).alias(f"mean_{n}") for n in names],
        *[(F.stddev_pop(n) + F.lit(1e-6)).alias(f"std_{n}") for n in names],
    )


def live_windows(
    lake: DataFrame, seq_len: int = SEQ_LEN, features: Sequence[str] = FEATURES
) -> DataFrame:
    """The newest ``seq_len`` rows of each station as one window, for the day after them."""
    last = newest(lake, KEY, ORDER, seq_len)
    step = F.struct("date", F.array(*features).alias("x"))
    newest_row = F.col("_rank") == 1
    return (
        last.groupBy(*KEY)
        .agg(
            F.transform(F.sort_array(F.collect_list(step)), lambda s: s["x"]).alias("window"),
            *[F.avg(f).alias(f"avg_{f}") for f in features],
            *[F.max(F.when(newest_row, F.col(f))).alias(f"last_{f}") for f in features],
            F.max("date").alias("date"),
            F.max(F.when(newest_row, F.col("market_yes_price"))).alias("market_yes_price"),
            F.max(F.when(newest_row, F.col("threshold_f"))).alias("threshold_f"),
            F.count(F.lit(1)).alias("_n"),
        )
        .where(F.col("_n") == seq_len)
        .drop("_n")
    )
