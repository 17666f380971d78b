"""Mixing sources to target weights, in blocks of words dealt to output shards.

The documents of a source, in the order of a hash, are one stream of words, cut into blocks of
equal length. A source's quota is the number of blocks, in an order given by a hash of the block,
that reaches its target; the last one is cut to it. Beyond its size a source is drawn a second
time, in another order, so no word is taken more than twice.

Which blocks go to which shard follows from a splitting tree: the shards are halved again and
again, and at each half the quotas of all sources are split exactly, by a draw of the multivariate
hypergeometric distribution - as if all blocks were shuffled and dealt, without shuffling them.
Such a draw is itself made top-down, over groups of ``FAN`` sources, by the distribution function of one
source against the rest. A shard then holds a range of each source's permuted blocks, which no
other shard holds, and orders its blocks by a hash.

All randomness is hashes of a seed, the documents and the blocks, so reruns agree whatever the
partitioning.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from edgeframe.llm.common import staged, text_of
from edgeframe.llm.sharding import positioned

#: Weights of the sources in their order, repeating.
WEIGHTS = (3, 1, 2)
#: Words of the mix, as a share of all words: numerator and denominator.
SHARE = (3, 2)
#: Times a source is taken, at most.
MOST = 2
SHARDS = 16
#: Words of a block.
BLOCK = 1024
#: Sources whose counts are drawn together.
FAN = 32

WORD = r"[^\x20\x09-\x0D]+"


def _long(value: Column) -> Column:
    return value.cast("long")


def _placed(rows: DataFrame, name: str, *order: Column) -> DataFrame:
    """``rows`` staged in ``order``, with ``_place``; equal rows may be split between tasks."""
    numbered = rows.withColumn("_from", F.monotonically_increasing_id())
    partitions = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    in_order = numbered.repartitionByRange(partitions, *order, "_from").sortWithinPartitions(*order, "_from")
    return staged(in_order.drop("_from").withColumn("_place", F.monotonically_increasing_id()), name)


# --- targets ------------------------------------------------------------------------------


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """``sources`` (``source``, ``source_size``) with ``_rank`` and ``target``.

    Weights repeat along the sources in code point order, null last. What a source gets above
    ``MOST`` times its size is shared again by weight. Each turn sums two columns over all
    sources; a turn caps at least one more source, and in practice a few turns cap all.
    """
    ranked = _placed(sources, "mix-sources", F.asc_nulls_last("source"))
    ranked = positioned(ranked, "source_size").withColumnRenamed("_number", "_rank").drop("_place", "_start")
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("_rank") % len(weights) + 1).cast("int"))
    ranked = staged(ranked.withColumn("_weight", _long(weight)), "mix-ranks")
    room = F.col("source_size") * MOST
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    capped, known = F.lit(False), -1
    while True:
        full, open_weight, count = ranked.agg(
            F.coalesce(F.sum(F.when(capped, room)), _long(F.lit(0))),
            F.coalesce(F.sum(F.when(~capped, F.col("_weight"))), _long(F.lit(0))),
            F.count_if(capped),
        ).first()
        if count == known or not open_weight:
            break
        known = count
        # The share of a source is its weight times level / parts.
        level, parts = SHARE[0] * total - SHARE[1] * full, SHARE[1] * open_weight
        wide = T.DecimalType(19, 0)
        capped = F.col("_weight").cast(wide) * F.lit(level).cast(wide) > room.cast(wide) * F.lit(parts).cast(wide)
    share = (F.col("_weight") * F.lit(level)).cast("double") / F.lit(float(parts)) if total else F.lit(0.0)
    return ranked.withColumn("target", F.when(capped, room.cast("double")).otherwise(share)).drop("_weight")


# --- the splitting tree -------------------------------------------------------------------


def hypergeometric(good: Column, bad: Column, draws: Column, uniform: Column) -> Column:
    """A draw of the number of good ones among ``draws`` of ``good + bad``, by its distribution.

    Probabilities are followed by their ratios over all values within 12 standard deviations,
    beyond which less than 1e-30 is left.
    """
    g, b, m = (c.cast("double") for c in (good, bad, draws))
    everything = F.greatest(g + b, F.lit(2.0))
    low, high = F.greatest(draws - bad, _long(F.lit(0))), F.least(draws, good)
    mode = F.greatest(low, F.least(high, _long(F.floor((m + 1) * (g + 1) / (g + b + 2)))))
    variance = m * (g / everything) * (b / everything) * ((g + b - m) / (everything - 1))
    reach = _long(F.ceil(12 * F.sqrt(F.greatest(variance, F.lit(0.0))))) + 12
    first, last = F.greatest(low, mode - reach), F.least(high, mode + reach)

    def start(limit: Column) -> Column:
        # What steps need is part of their state, so that it is worked out once.
        return F.struct(
            F.lit(1.0).alias("p"), F.lit(0.0).alias("sum"), _long(F.lit(0)).alias("passed"),
            g.alias("g"), b.alias("b"), m.alias("m"), limit.alias("limit"),
        )

    def step(s: Column, x: Column) -> Column:
        at, reached = x.cast("double"), s["sum"] + s["p"]
        below = F.greatest((at + 1) * (s["b"] - s["m"] + at + 1), F.lit(1.0))
        return F.struct(
            (s["p"] * (s["g"] - at) * (s["m"] - at) / below).alias("p"),
            reached.alias("sum"),
            (s["passed"] + (reached <= s["limit"]).cast("long")).alias("passed"),
            *[s[c].alias(c) for c in ("g", "b", "m", "limit")],
        )

    values = F.sequence(first, last)
    whole = F.aggregate(values, start(F.lit(-1.0)), step)["sum"]
    return F.least(last, first + F.aggregate(values, start(uniform * whole), step)["passed"])


def _uniform(*parts: Column) -> Column:
    """A number in [0, 1) that depends on ``parts`` only."""
    return F.pmod(F.xxhash64(*parts), F.lit(1 << 53)).cast("double") / F.lit(float(1 << 53))


def _drawn_counts(counts: DataFrame, groups: int, seed: int) -> DataFrame:
    """(``_lo``, ``_hi``, ``_rank``, ``_left``): how many of each source's blocks the left half of a node gets.

    ``counts`` has a row per node and source with ``_n``, and ``_draws`` of the node.
    """
    node = ["_lo", "_hi"]
    depth, span = 1, FAN
    while span < groups:
        depth, span = depth + 1, span * FAN
    wanted = counts.groupBy(*node).agg(F.first("_draws").alias("_draws")).withColumn("_group", _long(F.lit(0)))
    for level in range(depth - 1, -1, -1):
        kids = counts.groupBy(*node, F.floor(F.col("_rank") / FAN**level).alias("_kid")).agg(F.sum("_n").alias("_n"))
        lists = kids.groupBy(*node, F.floor(F.col("_kid") / FAN).alias("_group")).agg(
            F.array_sort(F.collect_list(F.struct("_kid", "_n"))).alias("_kids")  # FAN at most
        )
        together = lists.join(wanted, [*node, "_group"])
        whole = F.aggregate("_kids", _long(F.lit(0)), lambda s, k: s + k["_n"])
        none = F.array().cast("array<struct<_group:bigint,_draws:bigint>>")

        def draw(s: Column, kid: Column) -> Column:
            u = _uniform(F.lit(seed), F.col("_lo"), F.col("_hi"), F.lit(level), kid["_kid"])
            got = hypergeometric(kid["_n"], s["rest"] - kid["_n"], s["draws"], u)
            out = F.concat(s["out"], F.array(F.struct(kid["_kid"].alias("_group"), got.alias("_draws"))))
            return F.struct((s["rest"] - kid["_n"]).alias("rest"), (s["draws"] - got).alias("draws"), out.alias("out"))

        start = F.struct(whole.alias("rest"), F.col("_draws").alias("draws"), none.alias("out"))
        wanted = together.select(*node, F.inline(F.aggregate("_kids", start, draw)["out"]))
    return wanted.select(*node, F.col("_group").alias("_rank"), F.col("_draws").alias("_left"))


def split_quotas(quotas: DataFrame, shards: int = SHARDS, seed: int = 0) -> DataFrame:
    """(``shard``, ``_rank``, ``_n``): the quotas (``_rank``, ``_n``) split exactly over the shards.

    Shards get equal numbers of blocks, at most one apart. Tables of shards x sources rows.
    """
    total, groups = quotas.agg(F.sum("_n"), F.max("_rank") + 1).first()
    total = total or 0
    counts = quotas.select(
        _long(F.lit(0)).alias("_lo"), _long(F.lit(shards)).alias("_hi"), "_rank", _long(F.col("_n")).alias("_n")
    )

    def before(shard: Column) -> Column:
        return F.floor(shard * F.lit(total) / F.lit(shards)) if total < 1 << 40 else (
            shard.cast("decimal(19,0)") * F.lit(total).cast("decimal(19,0)") / F.lit(shards)
        ).cast("long")

    middle = F.floor((F.col("_lo") + F.col("_hi")) / 2)
    for _ in range(max(0, shards - 1).bit_length()):
        inner = F.col("_hi") - F.col("_lo") > 1
        nodes = counts.withColumn("_draws", before(middle) - before(F.col("_lo")))
        left = _drawn_counts(nodes.where(inner), groups or 1, seed)
        joined = nodes.join(left, ["_lo", "_hi", "_rank"], "left")
        halves = F.when(
            inner,
            F.array(
                F.struct(F.col("_lo"), middle.alias("_hi"), F.col("_left").alias("_n")),
                F.struct(middle.alias("_lo"), F.col("_hi"), (F.col("_n") - F.col("_left")).alias("_n")),
            ),
        ).otherwise(F.array(F.struct("_lo", "_hi", "_n")))
        counts = staged(joined.select("_rank", F.inline(halves)).select("_lo", "_hi", "_rank", "_n"), "mix-split")
    return counts.select(F.col("_lo").cast("int").alias("shard"), "_rank", "_n")


# --- streams, blocks and shards -----------------------------------------------------------


@dataclass(frozen=True)
class Mix:
    """``docs``: a row per document with ``_row``, ``size``, ``source_size`` and ``target``.
    ``pieces``: where a document lies in blocks (``_rank``, ``_nr_block``, ``_first``, ``_end``).
    ``blocks``: the blocks drawn, with ``_take`` words, ``_epoch``, ``shard`` and ``_order``."""

    docs: DataFrame
    pieces: DataFrame
    blocks: DataFrame


def mix(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    shards: int = SHARDS,
    block: int = BLOCK,
    seed: int = 0,
    with_words: bool = False,
) -> Mix:
    """The mix of ``docs``; ``with_words`` keeps the words of each piece.

    A null text has no words, and documents without words are in no block; a null source is a
    source of its own; null keys and repeated rows count like other rows, in the order of their
    texts' hashes. An empty table gives empty results. Nothing is left out: what a source has
    beyond its target is simply not drawn.
    """
    words = F.regexp_extract_all(text_of(text), F.lit(WORD), F.lit(0))
    salted = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit("")))
    rows = docs.select(
        F.col(key).alias("doc_id"),
        F.col(source).cast("string").alias("source"),
        _long(F.regexp_count(text_of(text), F.lit(WORD))).alias("size"),
        F.md5(salted.cast("binary")).alias("_hash"),
        F.md5(text_of(text).cast("binary")).alias("_tie"),
        *([words.alias("_words")] if with_words else []),
    )
    in_order = _placed(rows, "mix-rows", F.asc_nulls_last("source"), F.col("_hash"), F.col("_tie"))
    narrow = positioned(in_order.select("_place", "doc_id", "source", "size"), "size")
    narrow = staged(narrow.withColumnRenamed("_place", "_row"), "mix-places")
    whole = narrow.groupBy("source").agg(F.sum("size").alias("source_size"), F.min("_start").alias("_base"))
    sources = staged(targets(whole, weights), "mix-targets").withColumnRenamed("source", "_source")
    same = F.col("source").eqNullSafe(F.col("_source"))
    # One row per source: broadcast by Spark while it is small, else a join split by size.
    placed = narrow.join(sources, same).withColumn("_at", F.col("_start") - F.col("_base"))
    placed = staged(placed.drop("_source", "_start", "_number", "_base"), "mix-docs")

    first, end = F.col("_at"), F.col("_at") + F.col("size")
    in_blocks = placed.where("size > 0").withColumn(
        "_nr_block", F.explode(F.sequence(F.floor(first / block), F.floor((end - 1) / block)))
    )
    start = F.col("_nr_block") * block
    pieces = in_blocks.select(
        "_row",
        "_rank",
        "_nr_block",
        (F.greatest(first, start) - start).alias("_first"),
        (F.least(end, start + block) - start).alias("_end"),
        (F.greatest(first, start) - first).alias("_skip"),
        F.least(_long(F.lit(block)), F.col("source_size") - start).alias("_length"),
        "source_size",
        _long(F.floor("target")).alias("_wanted"),
    )
    pieces = staged(pieces, "mix-pieces")
    blocks = _drawn_blocks(pieces, shards, seed)
    pieces = pieces.drop("_length", "source_size", "_wanted")
    if with_words:
        texts = in_order.select(F.col("_place").alias("_row"), "_words")
        pieces = pieces.join(texts, "_row").withColumn(
            "_words", F.slice("_words", (F.col("_skip") + 1).cast("int"), (F.col("_end") - F.col("_first")).cast("int"))
        )
    return Mix(placed.drop("_at"), pieces, blocks)


def _drawn_blocks(pieces: DataFrame, shards: int, seed: int) -> DataFrame:
    """(``_rank``, ``_nr_block``, ``_epoch``, ``_take``, ``shard``, ``_order``) of the blocks taken."""
    # A block is listed by the one piece that starts it.
    twice = F.when(F.col("_wanted") > F.col("source_size"), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    listed = pieces.where("_first = 0 and _wanted > 0").select("_rank", "_nr_block", "_length", "_wanted", F.explode(twice).alias("_epoch"))
    name = F.concat_ws(":", F.lit(str(seed)), "_rank", "_epoch", "_nr_block")
    listed = listed.withColumn("_hash", F.md5(name.cast("binary")))
    in_order = _placed(listed, "mix-blocks", F.col("_rank"), F.col("_epoch"), F.col("_hash"))
    numbered = staged(positioned(in_order, "_length"), "mix-order")
    firsts = numbered.groupBy("_rank").agg(F.min("_start").alias("_s"), F.min("_number").alias("_nr"))
    taken = (
        numbered.join(firsts, "_rank")
        .withColumn("_take", F.least(F.col("_length"), F.col("_wanted") - (F.col("_start") - F.col("_s"))))
        .where("_take > 0")
        .select("_rank", "_nr_block", "_epoch", "_take", "_hash", (F.col("_number") - F.col("_nr")).alias("_draw"))
    )
    quotas = staged(taken.groupBy("_rank").agg(F.count(F.lit(1)).alias("_n")), "mix-quotas")
    split = split_quotas(quotas, shards, seed)
    # A row per source with the counts of its shards; a shard begins where those before it end.
    ranges = split.groupBy("_rank").agg(F.array_sort(F.collect_list(F.struct("shard", "_n"))).alias("_counts"))
    start = F.struct(_long(F.lit(0)).alias("before"), F.lit(0).alias("shard"))

    def find(s: Column, c: Column) -> Column:
        end = s["before"] + c["_n"]
        return F.struct(end.alias("before"), (s["shard"] + (F.col("_draw") >= end).cast("int")).alias("shard"))

    found = taken.join(ranges, "_rank").withColumn("_index", F.aggregate("_counts", start, find)["shard"])
    shard = F.element_at("_counts", F.col("_index") + 1)["shard"]
    order = F.md5(F.concat(F.col("_hash"), shard.cast("string")).cast("binary"))
    return found.select("_rank", "_nr_block", "_epoch", "_take", shard.alias("shard"), order.alias("_order"))


def report(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """(``doc_id``, ``size``, ``source_size``, ``target``, ``taken``), a row per document."""
    mixed = mix(docs, key, text, source)
    part = F.least(F.col("_end"), F.col("_take")) - F.col("_first")
    taken = (
        mixed.pieces.join(mixed.blocks, ["_rank", "_nr_block"])
        .groupBy("_row")
        .agg(F.sum(F.greatest(part, _long(F.lit(0)))).alias("taken"))
    )
    return mixed.docs.join(taken, "_row", "left").select(
        "doc_id", "size", "source_size", "target", F.coalesce("taken", _long(F.lit(0))).alias("taken")
    )


def shards_of_text(docs: DataFrame, block: int = BLOCK, **options) -> DataFrame:
    """(``shard``, ``slot``, ``source_rank``, ``text``): the blocks drawn, in their shuffled order.

    Slots count from 0 in each shard; a block is at most ``block`` words, parted by blanks.
    """
    mixed = mix(docs, block=block, with_words=True, **options)
    name = ["_rank", "_nr_block"]
    parts = mixed.pieces.groupBy(*name).agg(F.array_sort(F.collect_list(F.struct("_first", "_words"))).alias("_parts"))
    words = F.flatten(F.transform("_parts", lambda p: p["_words"]))
    placed = positioned(
        _placed(mixed.blocks, "mix-shards", F.col("shard"), F.col("_order")), "_take"
    )
    firsts = placed.groupBy("shard").agg(F.min("_number").alias("_nr"))
    return placed.join(firsts, "shard").join(parts, name).select(
        "shard",
        (F.col("_number") - F.col("_nr")).alias("slot"),
        F.col("_rank").alias("source_rank"),
        F.array_join(F.slice(words, 1, F.col("_take").cast("int")), " ").alias("text"),
    )
