"""Ordered computations over one key, cut into bounded blocks.

A window with ``partitionBy(key)`` puts all rows of a key into one task, so one hot key
decides the run time. Here the rows of a key are cut into blocks that follow the order
(``_block``). A partial aggregate makes one small row per (key, block); a window over
those block rows carries state from block to block; the rows themselves are only ever
partitioned by (key, block). Results equal those of the plain window.

The block column must be monotone in the order and bound the rows of a block: ``day_blocks`` for
one row per day, ``seq_blocks`` for dense unique numbers, ``bounded_blocks`` for any numbers.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from edgeframe.defaults import DAY_BLOCK, SEQ_BLOCK
from edgeframe.storage import staged

BLOCK = "_block"


def day_blocks(date: str = "date", days: int = DAY_BLOCK) -> Column:
    """Blocks of ``days`` calendar days: at most that many rows where days are unique."""
    return F.expr(f"unix_date({date}) div {days}")


def seq_blocks(seq: str = "seq", size: int = SEQ_BLOCK) -> Column:
    """Blocks of ``size`` sequence numbers: at most that many rows where numbers are unique."""
    return F.expr(f"{seq} div {size}")


def bounded_blocks(
    df: DataFrame,
    keys: Sequence[str],
    order: Column,
    rows: int = SEQ_BLOCK,
    by: Sequence[str] = (),
    ends: dict[str, Column] | None = None,
) -> tuple[DataFrame, DataFrame | None]:
    """``df`` with ``_block`` by rows: at most ``2 * rows`` of a key, however ``order`` is spread.

    Also a table of the blocks of keys with more than one, or None if there is no such key:
    ``keys``, ``_block`` and columns ``by`` with the aggregates ``ends``. ``keys`` must not be null.

    A block is named by where its range of ``order`` (a long) begins. A key's range is cut into
    equal widths for its number of rows; ranges that still hold too many are cut again between
    their own least and largest value, until none does. So sparse numbers, such as times in
    nanoseconds, give few blocks, and rows crowded into one moment give many. Only equal values
    stay together, and nulls, which come first.
    """
    keys = list(keys)
    marked = df.withColumn("_order", order)
    bounds = [F.count(F.lit(1)).alias("_n"), F.min("_order").alias("_lo"), F.max("_order").alias("_hi")]
    # One row per key that needs more than a block: few, even where keys are many.
    wide = staged(marked.groupBy(*keys).agg(*bounds).where(F.col("_n") > rows), "wide-keys")
    if wide.isEmpty():
        return df.withColumn(BLOCK, F.lit(0).cast("long")), None
    zero = F.lit(0).cast("long")
    placed = _cells(marked.withColumn(BLOCK, zero), wide.withColumn(BLOCK, zero), keys, rows)
    more = [value.alias(name) for name, value in (ends or {}).items()]
    while True:
        inside = placed.where(F.col("_in"))
        # Read once for both what is too large and what the blocks hold.
        table = staged(inside.groupBy(*keys, BLOCK, *by).agg(*bounds, *more), "blocks")
        whole = table.groupBy(*keys, BLOCK).agg(
            F.sum("_n").alias("_n"), F.min("_lo").alias("_lo"), F.max("_hi").alias("_hi")
        )
        crowded = staged(whole.where((F.col("_n") > 2 * rows) & (F.col("_hi") > F.col("_lo"))), "crowded")
        if crowded.isEmpty():
            break
        # The parts of a crowded block take its place; all others stay as they are.
        still = wide.select(*keys).withColumn("_wide", F.lit(True))
        placed = _cells(placed.drop("_in"), crowded, keys, rows).drop("_in").join(still, keys, "left")
        placed = placed.withColumn("_in", F.coalesce("_wide", F.lit(False))).drop("_wide")
    return placed.drop("_order", "_in"), table.drop("_n", "_lo", "_hi")


def _cells(rows: DataFrame, wide: DataFrame, keys: list[str], size: int) -> DataFrame:
    """``rows`` with the blocks of ``wide`` cut into cells; ``_in`` tells which rows those are."""
    parts = F.ceil(F.col("_n") / size)
    wide = wide.withColumn("_width", F.ceil((F.col("_hi") - F.col("_lo") + 1) / parts)).drop("_n", "_hi")
    low = F.expr("_lo + (_order - _lo) div _width * _width")
    cell = F.coalesce(low, F.col("_lo") - 1, F.lit(0).cast("long"))
    # Few rows on the right, so Spark broadcasts them; if not, it splits hot keys on the left.
    return (
        rows.join(wide.withColumn("_in", F.lit(True)), [*keys, BLOCK], "left")
        .withColumn("_in", F.coalesce("_in", F.lit(False)))
        .withColumn(BLOCK, F.when(F.col("_in"), cell).otherwise(F.col(BLOCK)))
        .drop("_lo", "_width")
    )


def in_block(keys: Sequence[str], order: Sequence) -> "Window":
    return Window.partitionBy(*keys, BLOCK).orderBy(*order)


def earlier_blocks(keys: Sequence[str]) -> "Window":
    return (
        Window.partitionBy(*keys)
        .orderBy(BLOCK)
        .rowsBetween(Window.unboundedPreceding, -1)
    )


def _attach(df: DataFrame, carried: DataFrame, keys: Sequence[str]) -> DataFrame:
    # Left side is already hash-partitioned and sorted by (keys, block) after its window,
    # and no (key, block) is hot, so neither join strategy meets a skewed partition.
    return df.join(carried, [*keys, BLOCK], "left")


def prefix_sums(
    df: DataFrame, keys: Sequence[str], order: Sequence, sums: dict[str, Column]
) -> DataFrame:
    """Add running sums, current row included."""
    carried = df.groupBy(*keys, BLOCK).agg(
        *[F.sum(value).alias(f"_in_{name}") for name, value in sums.items()]
    )
    before = earlier_blocks(keys)
    carried = carried.select(
        *keys, BLOCK, *[F.sum(f"_in_{name}").over(before).alias(f"_in_{name}") for name in sums]
    )
    running = in_block(keys, order).rowsBetween(Window.unboundedPreceding, 0)
    rows = df.withColumns({f"_at_{n}": F.sum(v).over(running) for n, v in sums.items()})
    zero = F.lit(0)
    return (
        _attach(rows, carried, keys)
        .withColumns(
            {
                n: F.coalesce(F.col(f"_at_{n}"), zero) + F.coalesce(F.col(f"_in_{n}"), zero)
                for n in sums
            }
        )
        .drop(*[f"_at_{n}" for n in sums], *[f"_in_{n}" for n in sums])
    )


def with_carried(
    df: DataFrame, keys: Sequence[str], ends: DataFrame, slots: Sequence[str]
) -> DataFrame:
    """Rows of ``df`` plus, in every block, the row of each slot that was last before it.

    ``ends`` has, per (key, block), one struct column per slot: the last row of that slot in
    the block, or null. The copies are flagged ``_seed`` and belong before the block's own
    rows, so that a frame over the block finds the last value even if it is far back.
    """
    before = earlier_blocks(keys)
    carried = ends.select(
        *keys, BLOCK, *[F.last(s, ignorenulls=True).over(before).alias(s) for s in slots]
    )
    seeds = carried.select(
        *keys, BLOCK, F.explode(F.array_compact(F.array(*slots))).alias("_row")
    ).select(*keys, BLOCK, "_row.*", F.lit(True).alias("_seed"))
    rows = df.withColumn("_seed", F.lit(False)).unionByName(seeds, allowMissingColumns=True)
    # Shuffled here, before frame inputs are computed, to move the plain columns only.
    return rows.repartition(*keys, BLOCK)


def seeds_first(keys: Sequence[str], order: Sequence[str]) -> "Window":
    """Running frame of a block over its seeds, then its rows in order."""
    w = in_block(keys, [F.col("_seed").desc(), *order])
    return w.rowsBetween(Window.unboundedPreceding, 0)


def block_counts(df: DataFrame, keys: Sequence[str], present: Column | None = None) -> DataFrame:
    """(keys, block) with rows in the block, rows before it and rows of the whole key."""
    counted = F.count(F.lit(1)) if present is None else F.sum(present.cast("long"))
    rows = df.groupBy(*keys, BLOCK).agg(counted.alias("_cnt"))
    return rows.withColumns(
        {
            "_before": F.coalesce(F.sum("_cnt").over(earlier_blocks(keys)), F.lit(0)),
            "_total": F.sum("_cnt").over(Window.partitionBy(*keys)),
        }
    )


def positions(df: DataFrame, keys: Sequence[str], order: Sequence) -> DataFrame:
    """Add ``_pos`` (0-based place within the key) and ``_total`` (rows of the key)."""
    counts = block_counts(df, keys).drop("_cnt")
    rows = df.withColumn("_at", F.row_number().over(in_block(keys, order)))
    return (
        _attach(rows, counts, keys)
        .withColumn("_pos", F.col("_before") + F.col("_at") - 1)
        .drop("_at", "_before")
    )


def with_history(df: DataFrame, keys: Sequence[str], order: Sequence[str], n: int) -> DataFrame:
    """Rows of ``df`` plus, in every block, the ``n`` rows of the same key before it.

    The copies are flagged ``_seed``; frames that look back at most ``n`` rows may then be
    partitioned by (key, block). Only the last ``n`` rows of each block are copied, found by
    a ranked filter that Spark prunes before the shuffle.
    """
    counts = block_counts(df, keys).drop("_total")
    nearest = Window.partitionBy(*keys).orderBy(BLOCK).rowsBetween(1, n)
    reach = counts.select(
        *keys,
        BLOCK,
        (F.col("_before") + F.col("_cnt")).alias("_end"),
        F.collect_list(F.struct(F.col(BLOCK).alias("block"), F.col("_before").alias("start")))
        .over(nearest)
        .alias("_next"),
    ).where(F.size("_next") > 0)
    newest_first = in_block(keys, [F.col(c).desc() for c in order])
    seeds = (
        df.withColumn("_back", F.row_number().over(newest_first))
        .where(F.col("_back") <= n)
        .join(reach, [*keys, BLOCK])
        .withColumn("_to", F.explode("_next"))
        .where(F.col("_to.start") - (F.col("_end") - F.col("_back")) <= n)
        .withColumn(BLOCK, F.col("_to.block"))
        .select(*df.columns, F.lit(True).alias("_seed"))
    )
    return df.withColumn("_seed", F.lit(False)).unionByName(seeds)


def newest(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], n: int, salts: int = 32
) -> DataFrame:
    """The ``n`` rows of each key that come last in the order, ranked 1 = newest in ``_rank``.

    Each input task keeps at most ``n`` rows of a key; tasks are then merged in ``salts``
    groups and the groups last, so a hot key never reaches one task as a whole and the
    shuffle stays at ``n`` rows per key and task. Any grouping of tasks gives the same rows.
    """
    latest = [F.col(c).desc() for c in order]
    group = F.pmod(F.spark_partition_id(), F.lit(salts))
    part = Window.partitionBy(*keys, "_salt").orderBy(*latest)
    whole = Window.partitionBy(*keys).orderBy(*latest)
    return (
        df.withColumn("_salt", group)
        .withColumn("_rank", F.row_number().over(part))
        .where(F.col("_rank") <= n)
        .drop("_salt")
        .withColumn("_rank", F.row_number().over(whole))
        .where(F.col("_rank") <= n)
    )
