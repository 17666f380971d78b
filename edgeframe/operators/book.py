"""Latest quotes of all venues at every event, and the arbitrage between them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from edgeframe.defaults import MIN_SPREAD_PCT, SEQ_BLOCK
from edgeframe.functions.numeric import number
from edgeframe.operators.best_price import BASE, OTHER, QUOTE, SEED, STATE, states
from edgeframe.operators.blocks import BLOCK, bounded_blocks, seeds_first, with_carried
from edgeframe.sources.quotes import latency_us
from edgeframe.storage import staged

ORDER = ["seq", "venue", "yes_bid", "yes_ask"]


def usable(quotes: DataFrame) -> DataFrame:
    """Quotes with both prices positive; others would become a false best price."""
    return quotes.where((number(F.col("yes_bid")) > 0) & (number(F.col("yes_ask")) > 0))


def _covering(low: Column, high: Column) -> Column:
    """The aligned ranges (level, place) of 2 ** level numbers that together make [low, high]."""
    none = F.array().cast("array<struct<level:int,at:bigint>>")
    start = F.struct(low.alias("l"), high.alias("h"), none.alias("out"))

    def take(s: Column, level: Column) -> Column:
        def piece(at: Column, wanted: Column) -> Column:
            return F.when(wanted, F.array(F.struct(level.alias("level"), at.alias("at")))).otherwise(none)

        left = (s["l"] <= s["h"]) & (s["l"] % 2 == 1)
        l = s["l"] + left.cast("long")
        right = (l <= s["h"]) & (s["h"] % 2 == 0)
        out = F.concat(s["out"], piece(s["l"], left), piece(s["h"], right))
        h = s["h"] - right.cast("long")
        # What is covered stays so: nothing lies in [l, -1].
        h = F.when(l <= h, F.shiftright(h, 1)).otherwise(F.lit(-1).cast("long"))
        return F.struct(F.shiftright(l, 1).alias("l"), h.alias("h"), out.alias("out"))

    return F.aggregate(F.sequence(F.lit(0), _levels(high)), start, take)["out"]


def _levels(last: Column) -> Column:
    """Halvings until numbers up to ``last`` are one range."""
    return F.ceil(F.log2(last.cast("double") + 2)).cast("int")


def _ends() -> dict[str, Column]:
    """Per block and venue the number of the last quote, of those that come first and of the others."""
    return {
        "_any": F.max("_late"),
        "_end": F.max(F.when(F.col("_late"), F.col("seq"))),
        "_begin": F.max(F.when(~F.col("_late"), F.col("seq"))),
    }


def _carried(rows: DataFrame, table: DataFrame) -> DataFrame:
    """What the blocks of keys with several blocks must know of the blocks before.

    A venue that quotes in a block needs its last quote before it: a ``SEED``, one per venue and
    block. Of the venues silent in a block only the best price counts: one ``BASE`` row per block. A
    quote stands silently over a range of blocks; it is entered in the few aligned ranges that make
    it, and a block looks up those that hold it. So nothing is copied to every block in between.
    """
    # The last quotes are found by their numbers; few rows are left for the order among equals.
    last = table.where(F.col("venue").isNotNull())
    is_last = (F.col("_late") == F.col("_any")) & F.col("seq").eqNullSafe(
        F.when(F.col("_any"), F.col("_end")).otherwise(F.col("_begin"))
    )
    # A row per block and venue, read several times below; the quotes are read once for it.
    closing = staged(
        rows.where(F.col("_listed"))
        .join(last, ["_key", BLOCK, "venue"])
        .where(is_last)
        .groupBy("_key", BLOCK, "venue")
        .agg(F.max(F.struct("yes_bid", "yes_ask")).alias("_q")),
        "closing",
    )
    order = Window.partitionBy("_key").orderBy(BLOCK)
    blocks = table.select("_key", BLOCK).distinct().select(
        "_key",
        BLOCK,
        (F.row_number().over(order) - 1).cast("long").alias("_nr"),
        (F.count(F.lit(1)).over(Window.partitionBy("_key")) - 1).alias("_last"),
    )
    following = F.lead("_nr").over(Window.partitionBy("_key", "venue").orderBy("_nr"))
    standing = closing.join(blocks, ["_key", BLOCK]).withColumn("_next", following)
    seeds = standing.where("_next is not null").select(
        "_key", F.col("_next").alias("_nr"), "venue", "_q.yes_bid", "_q.yes_ask", F.lit(SEED).alias("_kind")
    )
    high = F.coalesce(F.col("_next"), F.col("_last") + 1) - 1
    silent = standing.withColumn("_high", high).where(F.col("_nr") < F.col("_high")).select(
        "_key", F.inline(_covering(F.col("_nr") + 1, F.col("_high"))), "venue", "_q"
    )
    ask = F.struct(F.col("_q.yes_ask").alias("price"), F.col("venue"))
    bid = F.struct((-F.col("_q.yes_bid")).alias("price"), F.col("venue"))
    ranges = silent.groupBy("_key", "level", "at").agg(F.min(ask).alias("_ask"), F.min(bid).alias("_bid"))
    holding = blocks.withColumn("level", F.explode(F.sequence(F.lit(0), _levels(F.col("_last")))))
    holding = holding.withColumn("at", F.expr("shiftright(_nr, level)"))
    best = holding.join(ranges, ["_key", "level", "at"]).groupBy("_key", "_nr").agg(
        F.min("_ask").alias("_ask"), F.min("_bid").alias("_bid")
    )
    first = standing.groupBy("_key", "venue").agg(F.min("_nr").alias("_nr"))
    newcomers = first.groupBy("_key", "_nr").agg(F.count(F.lit(1)).alias("_new"))
    before = Window.partitionBy("_key").orderBy("_nr").rowsBetween(Window.unboundedPreceding, -1)
    base = (
        blocks.join(newcomers, ["_key", "_nr"], "left")
        .withColumn("_seen", F.coalesce(F.sum("_new").over(before), F.lit(0)).cast("long"))
        .join(best, ["_key", "_nr"], "left")
        .select(
            "_key",
            "_nr",
            F.col("_ask.venue").alias("venue"),
            F.col("_bid.venue").alias("_other"),
            F.col("_ask.price").alias("yes_ask"),
            (-F.col("_bid.price")).alias("yes_bid"),
            "_seen",
            F.lit(BASE).alias("_kind"),
        )
    )
    both = seeds.unionByName(base, allowMissingColumns=True)
    named = both.join(blocks.select("_key", BLOCK, "_nr"), ["_key", "_nr"]).drop("_nr")
    return named.withColumn("market", F.when(F.col("_key") != "", F.substring("_key", 2, 1 << 30)))


def book_state(
    quotes: DataFrame,
    venues: Sequence[str] | None = None,
    block: Column | None = None,
    rows: int = SEQ_BLOCK,
    first: Column | None = None,
    crossed: bool = False,
) -> DataFrame:
    """Every quote with best ask, best bid, their venues and the number of venues seen.

    The book is kept per market in sequence order, over all venues there are, or only the
    listed ones; quotes of other venues, and of none, are rows that do not change it. Quotes
    for which ``first`` holds come before all others. A market is cut into blocks of at most
    about ``rows`` quotes, or by ``block``, a column monotone in that order. ``crossed`` leaves
    out, before rows come back from Python, those whose best bid is not above the best ask.
    """
    late = F.lit(True) if first is None else ~F.coalesce(first, F.lit(False))
    listed = F.col("venue").isNotNull()
    if venues is not None:
        listed = listed & F.col("venue").isin(list(venues))
    # Keys without nulls, so that plain joins keep a market without a name.
    key = F.when(F.col("market").isNull(), "").otherwise(F.concat(F.lit("="), F.col("market").cast("string")))
    marked = usable(quotes).withColumns({"_key": key, "_late": late, "_listed": listed})
    if block is None:
        number_ = F.when(F.col("_late"), F.col("seq")).cast("long")
        marked, table = bounded_blocks(marked, ["_key"], number_, rows, ["venue"], _ends())
    else:
        marked = marked.withColumn(BLOCK, block)
        table = marked.groupBy("_key", BLOCK, "venue").agg(*[v.alias(n) for n, v in _ends().items()])
    dealt = marked.withColumns(
        {
            "_kind": F.when(F.col("_listed"), F.lit(QUOTE)).otherwise(F.lit(OTHER)),
            "_other": F.lit(None).cast("string"),
            "_seen": F.lit(None).cast("long"),
        }
    )
    if table is not None:
        dealt = dealt.unionByName(_carried(marked, table), allowMissingColumns=True)
    # Base and seeds of a block come before its quotes; both kinds of quotes are in one order.
    early = F.when(F.col("_kind") > QUOTE, F.col("_kind")).otherwise(F.lit(QUOTE))
    dealt = dealt.repartition("_key", BLOCK).sortWithinPartitions("_key", BLOCK, early.desc(), "_late", *ORDER)
    names = quotes.columns
    schema = T.StructType([*quotes.schema.fields, *T.StructType.fromDDL(STATE).fields])
    sent = dealt.select(*names, BLOCK, "_kind", "_other", "_seen")
    return sent.mapInArrow(states(names, ["market", BLOCK], crossed), schema)


def arb_events(
    quotes: DataFrame,
    venues: Sequence[str] | None = None,
    min_spread: float = MIN_SPREAD_PCT,
    block: Column | None = None,
    rows: int = SEQ_BLOCK,
    first: Column | None = None,
    crossed: bool = False,
) -> DataFrame:
    """Every quote with ``spread_pct`` and whether it triggers a signal.

    No signal where the two best prices are on the same venue, even if another pair pays.
    ``crossed`` leaves out quotes at which the best bid is not above the best ask.
    """
    spread = (F.col("best_bid") - F.col("best_ask")) / F.col("best_ask")
    pays = (
        (F.col("ask_venue") != F.col("bid_venue"))
        & (F.col("best_bid") > F.col("best_ask"))
        & (F.col("spread_pct") >= F.lit(min_spread))
    )
    return book_state(quotes, venues, block, rows, first, crossed).withColumn("spread_pct", spread).withColumn(
        "is_signal", pays
    )


def signals_of(events: DataFrame) -> DataFrame:
    """Signal records of the triggering events; every signal counts as executed."""
    return events.where("is_signal").select(
        "market",
        F.col("ask_venue").alias("buy_venue"),
        F.col("bid_venue").alias("sell_venue"),
        F.col("best_ask").alias("buy_price"),
        F.col("best_bid").alias("sell_price"),
        "spread_pct",
        latency_us().cast("long").alias("latency_us"),
        F.col("recv_ns").alias("ts_ns"),
        "seq",
    )


def arb_signals(
    quotes: DataFrame,
    venues: Sequence[str] | None = None,
    min_spread: float = MIN_SPREAD_PCT,
    block: Column | None = None,
    rows: int = SEQ_BLOCK,
) -> DataFrame:
    """Cross-venue arbitrage signals: buy at the best ask, sell at the best bid."""
    return signals_of(arb_events(quotes, venues, min_spread, block, rows, crossed=True))


def asof_forecast(
    quotes: DataFrame,
    forecasts: DataFrame,
    fields: Sequence[str],
    time: str = "ts_ns",
    span: int | None = None,
    rows: int = SEQ_BLOCK,
) -> DataFrame:
    """Each quote with the latest forecast of its market at or before its time.

    Both sides are put in one ordered table, cut into blocks of about ``rows`` rows, or of
    ``span`` time units, so neither side is broadcast and a busy market, or a busy minute of one,
    is spread over its blocks.
    """
    key = F.when(F.col("market").isNull(), "").otherwise(F.concat(F.lit("="), F.col("market").cast("string")))
    left = quotes.withColumns({"_time": F.col(time), "_side": F.lit(1)})
    right = forecasts.select(
        "market",
        F.col(time).alias("_time"),
        F.lit(0).alias("_side"),
        F.struct(*fields).alias("_seen"),
    )
    both = left.unionByName(right, allowMissingColumns=True).withColumn("_key", key)
    if span is None:
        both, _ = bounded_blocks(both, ["_key"], F.col("_time").cast("long"), rows)
    else:
        both = both.withColumn(BLOCK, F.expr(f"_time div {span}"))
    row = F.when(F.col("_side") == 0, F.struct("_time", "_side", "_seen"))
    ends = both.groupBy("_key", BLOCK).agg(F.max(row).alias("_slot"))
    frame = seeds_first(["_key"], ["_time", "_side", "_seen"])
    filled = with_carried(both, ["_key"], ends, ["_slot"]).withColumn(
        "_last", F.last("_seen", ignorenulls=True).over(frame)
    )
    return filled.where(F.col("_side") == 1).select(
        *quotes.columns, *[F.col(f"_last.{f}").alias(f) for f in fields]
    )
