"""The trie of conversation prefixes, by vertical bitmaps.

Conversations are numbered in the order of their ids and cut into shards of about ``ROWS`` turns,
and long ones also into segments of ``SPAN`` turns, so a shard is bounded whatever a conversation
or a common beginning holds. A shard has one bitset over its conversations per (position, turn).
Walking depth-first, a node's bitset is intersected with the postings of the next position: the
children. Popcounts, smallest members and the lists of those that end there follow per node.

Nodes of different shards are the same if depth and beginning are equal; a beginning is known by
128 bits, the exclusive or of hashes of (position, turn). Counts of equal nodes are added. Sums
over subtrees are taken without following the tree over shards: a node is owned by its smallest
member; a shard lists its nodes depth-first, so a subtree is a range and its owned part a difference
of running sums; those parts add up over shards.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from edgeframe.llm.common import staged
from edgeframe.llm.sharding import positioned

#: Turns of a shard, on average, before what other conversations lend is added.
ROWS = 4096
#: Positions of a segment.
SPAN = 4096

NODE, GHOST, THROUGH = 0, 1, 2
_KEY = ["depth", "_k1", "_k2"]
_PART = (
    "_shard long, _segment long, _at int, _size int, _up int, _kind int, depth long, _k1 long, _k2 long, "
    "conv_id long, _n long, _ended long, _chars long, _ends string"
)
_SUMS = (
    "depth long, _k1 long, _k2 long, conv_id long, parent_conv_id long, n_convs long, "
    "n_children long, n_leaves long, saved_tokens long"
)


# --- conversations ------------------------------------------------------------------------


def turns_of(
    conversations: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """(``conv_id``, ``_number``, ``_turn``, ``_chars``) in the order of conversation and turn.

    ``_number`` counts all rows; ``_turn`` is a digest of role and text, null counting as empty.
    A null turn comes first, equal turns are in the order of their digests; rows without a
    ``conv_id`` belong to no conversation.
    """
    said, who = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (text, role))
    rows = conversations.where(F.col(key).isNotNull()).select(
        F.col(key).cast("long").alias("conv_id"),
        F.col(turn).alias("_order"),
        F.md5(F.concat(F.length(who).cast("string"), F.lit(":"), who, said).cast("binary")).alias("_turn"),
        F.length(said).cast("long").alias("_chars"),
        F.monotonically_increasing_id().alias("_from"),
    )
    by = ["conv_id", "_order", "_turn", "_from"]
    partitions = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    in_order = rows.repartitionByRange(partitions, *by).sortWithinPartitions(*by)
    in_order = staged(in_order.withColumn("_place", F.monotonically_increasing_id()).drop("_from"), "trie-turns")
    return positioned(in_order, "_chars").select("conv_id", "_number", "_turn", "_chars")


def _paths(turns: DataFrame, rebuilt: bool) -> DataFrame:
    """(``conv_id``, ``_shard``, ``depth``, ``_turn``, ``_chars``, ``_last``), roots included."""
    turns = staged(turns, "trie-numbers")
    convs = turns.groupBy("conv_id").agg(F.min("_number").alias("_first"), F.count(F.lit(1)).alias("_own"))
    convs = convs.withColumns(
        {
            "_skip": F.crc32(F.col("conv_id").cast("string").cast("binary")) % 6 if rebuilt else F.lit(0).cast("long"),
            "_base": F.col("conv_id") - F.col("conv_id") % 100 if rebuilt else F.col("conv_id"),
            "_shard": F.floor(F.col("_first") / ROWS),
        }
    )
    convs = staged(convs, "trie-convs")
    bases = convs.where("conv_id = _base").select(F.col("conv_id").alias("_base"), F.col("_own").alias("_has"))
    lent = F.least(F.col("_skip"), F.coalesce("_has", F.lit(0).cast("long")))
    convs = convs.join(bases, "_base", "left").withColumn("_lent", lent)
    convs = convs.withColumn("_length", F.col("_lent") + F.greatest(F.col("_own") - F.col("_skip"), F.lit(0)))
    convs = staged(convs.drop("_has"), "trie-lengths")
    # A long conversation is many rows of one key: Spark splits such a join.
    placed = turns.join(convs, "conv_id").withColumn("_nr", F.col("_number") - F.col("_first"))
    columns = ["conv_id", "_shard", "depth", "_turn", "_chars", "_length"]
    own = placed.where("_nr >= _skip").withColumn("depth", F.col("_lent") + F.col("_nr") - F.col("_skip") + 1)
    roots = convs.withColumns(
        {"depth": F.lit(0).cast("long"), "_turn": F.lit(None).cast("string"), "_chars": F.lit(0).cast("long")}
    )
    paths = own.select(*columns).unionByName(roots.select(*columns))
    if rebuilt:
        first = placed.where("conv_id % 100 = 0 and _nr < 5").select(
            F.col("conv_id").alias("_base"), (F.col("_nr") + 1).alias("depth"), "_turn", "_chars"
        )
        borrowed = convs.where("_lent > 0").join(first, "_base").where("depth <= _lent")
        paths = paths.unionByName(borrowed.select(*columns))
    return paths.withColumn("_last", F.col("depth") == F.col("_length"))


# --- a shard ------------------------------------------------------------------------------


def _ones(bits: int) -> Iterator[int]:
    while bits:
        low = bits & -bits
        yield low.bit_length() - 1
        bits ^= low


class Shard:
    """The trie of one shard: vertical bitmaps, walked depth-first.

    Rows are (conversation, level, hash of position and turn, length, whether it is the last);
    levels of a conversation count from 0 without gaps.
    """

    def __init__(self, convs, levels, hash1, hash2, chars, last) -> None:
        order = np.lexsort((levels, convs))
        levels, self.chars, last = levels[order], chars[order].tolist(), last[order]
        hash1, hash2 = hash1[order], hash2[order]
        self.names, first, counts = np.unique(convs[order], return_index=True, return_counts=True)
        owner = np.repeat(np.arange(len(self.names)), counts).tolist()
        self.first, self.counts = first.tolist(), counts.tolist()
        # Posting of each row: its number among the distinct (level, turn).
        by = np.lexsort((hash2, hash1, levels))
        fresh = np.ones(len(by), bool)
        fresh[1:] = (np.diff(levels[by]) != 0) | (np.diff(hash1[by]) != 0) | (np.diff(hash2[by]) != 0)
        posting = np.empty(len(by), np.int64)
        posting[by] = np.cumsum(fresh) - 1
        self.posting = posting.tolist()
        self.hash1 = hash1.view(np.uint64).tolist()
        self.hash2 = hash2.view(np.uint64).tolist()
        depth = int(levels.max(initial=0)) + 2
        self.bits = [0] * int(fresh.sum())
        self.alive, self.ending = [0] * depth, [0] * depth
        for row, (level, conv, end) in enumerate(zip(levels.tolist(), owner, last.tolist())):
            bit = 1 << conv
            self.bits[self.posting[row]] |= bit
            self.alive[level] |= bit
            if end:
                self.ending[level] |= bit

    def _kids(self, members: int, level: int) -> list[tuple[int, int]]:
        """(a row of the turn, members) of each distinct turn that ``members`` have at ``level``."""
        found, left = [], members & self.alive[level]
        while left:
            row = self.first[(left & -left).bit_length() - 1] + level
            child = members & self.bits[self.posting[row]]
            left &= ~child
            found.append((row, child))
        return found

    def walk(self) -> dict[str, list]:
        """Nodes in depth-first order; ``up`` is the place of the parent, -1 at level 0."""
        out: dict[str, list] = {c: [] for c in ("up", "level", "k1", "k2", "low", "n", "chars", "enders")}
        add = [out[c].append for c in out]
        stack = [(row, child, 0, -1, 0, 0) for row, child in reversed(self._kids(self.alive[0], 0))]
        while stack:
            row, members, level, up, k1, k2 = stack.pop()
            k1, k2 = k1 ^ self.hash1[row], k2 ^ self.hash2[row]
            low = (members & -members).bit_length() - 1
            at, count = len(out["up"]), members.bit_count()
            for put, value in zip(add, (up, level, k1, k2, low, count, self.chars[row], members & self.ending[level])):
                put(value)
            if count > 1:
                stack += [(r, child, level + 1, at, k1, k2) for r, child in reversed(self._kids(members, level + 1))]
                continue
            for level in range(level + 1, self.counts[low]):  # the rest of a single conversation
                row = self.first[low] + level
                k1, k2 = k1 ^ self.hash1[row], k2 ^ self.hash2[row]
                for put, value in zip(add, (at, level, k1, k2, low, 1, self.chars[row], members & self.ending[level])):
                    put(value)
                at += 1
        return out


def _sizes(up: list[int]) -> list[int]:
    sizes = [1] * len(up)
    for at in range(len(up) - 1, -1, -1):
        if up[at] >= 0:
            sizes[up[at]] += sizes[at]
    return sizes


def _signed(values: list[int]) -> pa.Array:
    return pa.array(np.array(values, np.uint64).view(np.int64))


def _shard_nodes(span: int):
    def run(rows: pa.Table) -> pa.Table:
        column = {c: rows.column(c).to_numpy() for c in rows.column_names}
        segment, shard = int(column["_segment"][0]), int(column["_shard"][0])
        base = segment * span - 1 if segment else 0
        trie = Shard(
            column["conv_id"], column["depth"] - base, column["_h1"], column["_h2"], column["_chars"], column["_last"]
        )
        out = trie.walk()
        names, size = trie.names, len(out["up"])
        level = np.array(out["level"], np.int64)
        # The node before a later segment stands there for its children only.
        ghost = (level == 0) & (segment > 0)
        ends = [",".join(str(names[i]) for i in _ones(e)) if e else None for e in out["enders"]]
        ended = np.array([e.bit_count() for e in out["enders"]], np.int64)
        table = {
            "_at": np.arange(size), "_size": np.array(_sizes(out["up"])), "_up": np.array(out["up"]),
            "_kind": np.where(ghost, GHOST, NODE), "depth": level + base,
            "conv_id": names[np.array(out["low"], np.int64)],
            "_n": np.where(ghost, 0, np.array(out["n"], np.int64)), "_ended": ended,
            "_chars": np.array(out["chars"], np.int64),
        }
        # Conversations that go on in the next segment, at the node where they leave this one.
        top = (segment + 1) * span - 1 - base
        on = [
            (at, names[i])
            for at, lv in enumerate(out["level"]) if lv == top
            for i in _ones(_members(trie, out, at) & ~trie.ending[top])
        ]
        whole = len(on)
        more = {c: np.zeros(whole, np.int64) for c in table}
        more["_at"], more["conv_id"] = np.array([a for a, _ in on], np.int64), np.array([c for _, c in on], np.int64)
        more["_kind"] = np.full(whole, THROUGH)
        more["depth"] = np.full(whole, top + base)
        columns = {c: pa.array(np.concatenate([table[c], more[c]])) for c in table}
        columns["_shard"] = pa.array(np.full(size + whole, shard))
        columns["_segment"] = pa.array(np.full(size + whole, segment))
        columns["_k1"] = _signed(out["k1"] + [0] * whole)
        columns["_k2"] = _signed(out["k2"] + [0] * whole)
        columns["_ends"] = pa.array(ends + [None] * whole, pa.string())
        fields = [f.strip().split() for f in _PART.split(",")]
        types = {"long": pa.int64(), "int": pa.int32(), "string": pa.string()}
        return pa.table({n: columns[n].cast(types[t]) for n, t in fields})

    return run


def _members(trie: Shard, out: dict[str, list], at: int) -> int:
    """Members of a node at the last level, from its smallest member's posting and those above."""
    members, level = -1, out["level"][at]
    row = trie.first[out["low"][at]]
    for step in range(level + 1):
        members &= trie.bits[trie.posting[row + step]]
        if members.bit_count() == 1:
            break
    return members


def _shard_sums(rows: pa.Table) -> pa.Table:
    """Sums over the subtrees of a shard's nodes, of what is owned in this shard."""
    c = {n: rows.column(n).fill_null(0).to_numpy() for n in rows.column_names if n != "_owner"}
    owner = rows.column("_owner").fill_null(-1).to_numpy()
    order = np.argsort(c["_at"] + np.where(c["_kind"] == THROUGH, 1 << 32, 0), kind="stable")
    c, owner = {n: v[order] for n, v in c.items()}, owner[order]
    size = int((c["_kind"] != THROUGH).sum())  # these come first, at their places
    up, kind = c["_up"][:size], c["_kind"][:size]
    owned = (kind == NODE) & (c["conv_id"][:size] == owner[:size])
    held = {}
    for name, column in (("n_leaves", "_leaf"), ("saved_tokens", "_saved")):
        own = np.where(owned, c[column][:size], 0)
        np.add.at(own, c["_at"][size:], c[column][size:])
        total = np.concatenate([[0], np.cumsum(own)])
        end = np.arange(size) + c["_size"][:size]
        held[name] = np.where(kind == NODE, total[end] - total[:-1], 0)
    children = np.bincount(up[owned & (up >= 0)], minlength=size)
    parent = pa.array(owner[np.maximum(up, 0)], mask=(up < 0) | (kind == GHOST))
    return pa.table(
        {
            **{n: pa.array(c[n][:size]) for n in _KEY},
            "conv_id": pa.array(owner[:size]), "parent_conv_id": parent, "n_convs": pa.array(c["_all"][:size]),
            "n_children": pa.array(children), "n_leaves": pa.array(held["n_leaves"]),
            "saved_tokens": pa.array(held["saved_tokens"]),
        }
    )


def _hashed(batches) -> Iterator[pa.RecordBatch]:
    """One digest per node of id lists that come in order; what is held is one running digest."""
    key, digest = None, None

    def row(key, digest):
        names = [*_KEY, "ends_sha256"]
        return pa.RecordBatch.from_arrays([pa.array([v]) for v in (*key, digest.hexdigest())], names=names)

    for batch in batches:
        keys = zip(*(batch.column(n).to_pylist() for n in _KEY))
        for one, ends in zip(keys, batch.column("_ends")):
            if one == key:
                digest.update(b",")
            else:
                if key is not None:
                    yield row(key, digest)
                key, digest = one, hashlib.sha256()
            digest.update(ends.as_py().encode())
    if key is not None:
        yield row(key, digest)


# --- all shards ---------------------------------------------------------------------------


def _with_segments(paths: DataFrame, span: int) -> DataFrame:
    """Rows with ``_segment``, and the beginning of each later segment as a row of its own."""
    hashed = paths.select(
        "conv_id",
        "_shard",
        F.floor(F.col("depth") / span).alias("_segment"),
        "depth",
        *[
            F.when(F.col("depth") == 0, F.lit(0).cast("long"))
            .otherwise(F.xxhash64(F.lit(n), "depth", "_turn"))
            .alias(f"_h{n}")
            for n in (1, 2)
        ],
        "_chars",
        "_last",
        "_length",
    )
    if not hashed.where(F.col("_length") >= span).head(1):
        return hashed.drop("_length")
    pieces = hashed.where(F.col("_length") >= span).groupBy("conv_id", "_shard", "_segment").agg(
        F.expr("bit_xor(_h1)").alias("_h1"), F.expr("bit_xor(_h2)").alias("_h2")
    )
    # One row per SPAN turns of a long conversation.
    before = Window.partitionBy("conv_id").orderBy("_segment").rowsBetween(Window.unboundedPreceding, -1)
    starts = pieces.select(
        "conv_id",
        "_shard",
        "_segment",
        (F.col("_segment") * span - 1).alias("depth"),
        F.expr("bit_xor(_h1)").over(before).alias("_h1"),
        F.expr("bit_xor(_h2)").over(before).alias("_h2"),
        F.lit(0).cast("long").alias("_chars"),
        F.lit(False).alias("_last"),
    )
    return hashed.drop("_length").unionByName(starts.where("_segment > 0"))


def _tails(joined: DataFrame) -> DataFrame:
    """What conversations own in later segments, as values of the nodes where they leave one."""
    through = joined.where(F.col("_kind") == THROUGH).drop("_saved", "_leaf")
    owned = joined.where((F.col("_kind") == NODE) & (F.col("conv_id") == F.col("_owner")))
    zero = F.lit(0).cast("long")
    parts = (
        owned.join(through.select("conv_id").distinct(), "conv_id", "left_semi")
        .select("conv_id", "_segment", "_saved", "_leaf")
        .unionByName(through.select("conv_id", "_segment", zero.alias("_saved"), zero.alias("_leaf")))
        .groupBy("conv_id", "_segment")
        .agg(F.sum("_saved").alias("_saved"), F.sum("_leaf").alias("_leaf"))
    )
    later = Window.partitionBy("conv_id").orderBy(F.desc("_segment")).rowsBetween(Window.unboundedPreceding, -1)
    sums = parts.select(
        "conv_id",
        "_segment",
        F.coalesce(F.sum("_saved").over(later), zero).alias("_saved"),
        F.coalesce(F.sum("_leaf").over(later), zero).alias("_leaf"),
    )
    return through.join(sums, ["conv_id", "_segment"])


def nodes(
    conversations: DataFrame,
    key: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    rebuilt: bool = False,
    span: int = SPAN,
) -> DataFrame:
    """One row per distinct beginning of a conversation, the root (``depth`` 0) included.

    ``conv_id``: the smallest member; ``parent_conv_id``: the parent's (null at the root);
    ``n_convs``, ``n_children``, ``n_leaves``; ``saved_tokens``: over the subtree, characters of a
    node's last text for each member but one; ``ends_sha256``: of the ids of those that end there,
    ascending, with commas. ``rebuilt``: each conversation c begins with the first crc32(c) % 6
    turns of conversation c - c % 100 instead of its own.

    Null roles and texts are empty ones; null turns come first, equal turns are ordered by a
    digest of role and text; rows with a null id belong to no conversation. Repeated rows are
    turns of their own. An empty table has no node. Texts count by their digests, however long.
    """
    turns = turns_of(conversations, key, turn, role, text)
    rows = _with_segments(_paths(turns, rebuilt), span)
    parts = staged(rows.groupBy("_shard", "_segment").applyInArrow(_shard_nodes(span), _PART), "trie-parts")
    real = parts.where(F.col("_kind") == NODE)
    whole = real.groupBy(*_KEY).agg(
        F.min("conv_id").alias("_owner"),
        F.sum("_n").alias("_all"),
        (F.sum("_n") == F.sum("_ended")).cast("long").alias("_leaf"),
        ((F.sum("_n") - 1) * F.max("_chars")).alias("_saved"),
    )
    narrow = parts.drop("_ends", "_n", "_ended", "_chars")
    joined = staged(narrow.join(whole, _KEY, "left"), "trie-nodes")
    summed = joined.where(F.col("_kind") != THROUGH)
    if joined.where(F.col("_kind") == THROUGH).head(1):
        summed = summed.unionByName(_tails(joined))
    sums = summed.groupBy("_shard", "_segment").applyInArrow(_shard_sums, _SUMS)
    # All of a node's lists in one order; a task holds a digest, not the lists.
    partitions = int(parts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    lists = real.where("_ends is not null").select(*_KEY, "_shard", "_ends")
    lists = lists.repartition(partitions, *_KEY).sortWithinPartitions(*_KEY, "_shard").drop("_shard")
    digests = lists.mapInArrow(_hashed, "depth long, _k1 long, _k2 long, ends_sha256 string")
    both = sums.withColumn("ends_sha256", F.lit(None).cast("string")).unionByName(digests, allowMissingColumns=True)
    return both.groupBy(*_KEY).agg(
        F.max("conv_id").alias("conv_id"),
        F.max("parent_conv_id").alias("parent_conv_id"),
        F.max("n_convs").alias("n_convs"),
        *[F.sum(c).alias(c) for c in ("n_children", "n_leaves", "saved_tokens")],
        F.coalesce(F.max("ends_sha256"), F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    ).select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
