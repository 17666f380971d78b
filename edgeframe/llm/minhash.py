"""MinHash near-dedup by an inverted join over signature coordinates.

A document is the set of its distinct five-word shingles. Documents with equal sets form a class
and only classes go on. Each class is posted under the pairs (coordinate, value) of its
signature. Classes that agree in at least ``MATCHES`` of ``COORDINATES`` places must meet in the
rarest ``COORDINATES - MATCHES + 1`` pairs of either, so only these are posted (prefix), pairs
that one class alone has are skipped, and so are classes with fewer than ``MATCHES`` shared
pairs. What meets is counted on the whole signatures, and confirmed on the full sets.

Large postings are not expanded into all pairs. First every class is compared with the hub of
each of its postings; after components are formed, only postings that still hold several
components are compared in full, inside tiles, and only across components. A link that is not
looked for this way lies inside a component, so components are those of all links.

For similarity 0.75, 48 of 64 places agree on average; fewer than 32 with a chance of about
3e-6 for a pair just at the threshold.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from edgeframe.llm.bpe import utf8
from edgeframe.llm.common import free_name, kept_in_worker, let_go, staged, text_of

WORDS = 5
COORDINATES = 64
MATCHES = 32
#: Similarity asked for, in hundredths.
PERCENT = 75
#: Members of a tile of a posting.
TILE = 1024
#: Distinct words a worker remembers.
MEMORY = 200_000

#: What a document is known by: key, hash of its text, and a row number if it has no key.
_ROW = ["doc_id", "_mark", "_place"]

_ODD = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Sorted distinct 64-bit shingle hashes of texts; words are hashed once while remembered."""

    def __init__(self, words: int = WORDS, memory: int = MEMORY) -> None:
        self.words, self._memory = words, memory
        powers = [1]
        for _ in range(1, words):
            powers.append(powers[-1] * int(_ODD) % (1 << 64))
        self._powers = np.array(powers, np.uint64)
        self._forget()

    def _forget(self) -> None:
        self._place: dict[bytes, int] = {}
        self._hashes = np.empty(0, np.uint64)

    def _learn(self, fresh: Iterable[bytes]) -> None:
        fresh = list(fresh)
        digests = b"".join(hashlib.blake2b(w, digest_size=8).digest() for w in fresh)
        self._place.update(zip(fresh, range(len(self._place), len(self._place) + len(fresh))))
        self._hashes = np.concatenate([self._hashes, np.frombuffer(digests, "<u8")])

    def _set(self, hashes: np.ndarray) -> np.ndarray:
        n = len(hashes)
        if not n:
            return hashes
        width = min(n, self.words)
        total = np.zeros(n - width + 1, np.uint64)
        for j in range(width):
            total += hashes[j : n - width + 1 + j] * self._powers[j]
        return np.unique(_mixed(total + np.uint64(width)))

    def sets(self, texts: Iterable[bytes]) -> Iterator[np.ndarray]:
        group: list[list[bytes]] = []
        size = 0
        for text in texts:
            group.append(text.lower().split())  # of bytes: A-Z and ASCII white space only
            size += len(text)
            if size >= 1 << 20:
                yield from self._group(group)
                group, size = [], 0
        yield from self._group(group)

    def _group(self, group: list[list[bytes]]) -> Iterator[np.ndarray]:
        fresh = {w for words in group for w in words}.difference(self._place)
        if len(self._place) + len(fresh) > self._memory:
            self._forget()
            fresh = {w for words in group for w in words}
        self._learn(fresh)
        place = self._place.__getitem__
        for words in group:
            yield self._set(self._hashes[np.fromiter(map(place, words), np.int64, len(words))])


def signatures(sets: list[np.ndarray], coordinates: int) -> np.ndarray:
    """The minimum of each of ``coordinates`` hash functions over each (non-empty) set."""
    rng = np.random.default_rng(20_240_501)
    masks = rng.integers(0, 1 << 63, coordinates, np.uint64)
    factors = rng.integers(0, 1 << 63, coordinates, np.uint64) * np.uint64(2) + np.uint64(1)
    result = np.empty((len(sets), coordinates), np.int32)
    at = 0
    while at < len(sets):
        stop, size = at, 0
        while stop < len(sets) and (stop == at or size + len(sets[stop]) <= 1 << 16):
            size += len(sets[stop])
            stop += 1
        hashes = np.concatenate(sets[at:stop])
        starts = np.cumsum([0, *map(len, sets[at : stop - 1])])
        for c in range(coordinates):
            lowest = np.minimum.reduceat((hashes ^ masks[c]) * factors[c], starts)
            result[at:stop, c] = (lowest >> np.uint64(32)).astype(np.uint32).view(np.int32)
        at = stop
    return result


def class_key(shingles: np.ndarray) -> bytes | None:
    """128 bits naming a set; none for the empty one."""
    if not len(shingles):
        return None
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def _shingler(words: int) -> Shingler:
    return kept_in_worker(("shingles", words), lambda: Shingler(words))


def signed(docs: DataFrame, words: int, coordinates: int) -> DataFrame:
    """(``doc_id``, ``_mark``, ``_place``, ``_class``, ``n_shingles``, ``_signature``) of all rows."""
    schema = docs.select(*_ROW).schema
    schema = schema.add("_class", T.BinaryType()).add("n_shingles", T.LongType())
    schema = schema.add("_signature", T.ArrayType(T.IntegerType()))

    def run(batches):
        for batch in batches:
            sets = list(_shingler(words).sets(utf8(batch.column("text"))))
            full = [i for i, s in enumerate(sets) if len(s)]
            rows = signatures([sets[i] for i in full], coordinates)
            counts = np.zeros(len(sets), np.int64)
            counts[full] = coordinates
            lists = pa.ListArray.from_arrays(
                pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()), pa.array(rows.reshape(-1))
            )
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(c) for c in _ROW],
                    pa.array([class_key(s) for s in sets], pa.binary()),
                    pa.array([len(s) for s in sets], pa.int64()),
                    lists,
                ],
                names=schema.names,
            )

    return docs.mapInArrow(run, schema)


def full_sets(docs: DataFrame, words: int) -> DataFrame:
    """(``_class``, ``_set``) of documents: the whole set as bytes."""

    def run(batches):
        for batch in batches:
            for shingles in _shingler(words).sets(utf8(batch.column("text"))):
                if len(shingles):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([class_key(shingles)], pa.binary()),
                         pa.array([shingles.tobytes()], pa.binary())],
                        names=["_class", "_set"],
                    )

    return docs.select("text").mapInArrow(run, "_class binary, _set binary")


def similar(a: bytes, b: bytes, percent: int) -> bool:
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
        return False
    merged = np.sort(np.concatenate([x, y]), kind="stable")
    both = int(np.count_nonzero(merged[1:] == merged[:-1]))
    return 100 * both >= percent * (len(x) + len(y) - both)


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (``a``, ``b``) whose full sets are similar enough."""

    def run(batches):
        let_go()
        for batch in batches:
            first, second = batch.column("_set_a"), batch.column("_set_b")
            held = [similar(x.as_py(), y.as_py(), percent) for x, y in zip(first, second)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("a"), batch.column("b")], names=["a", "b"]
            ).filter(pa.array(held, pa.bool_()))

    joined = pairs.join(sets.select(F.col("id").alias("b"), F.col("_set").alias("_set_b")), "b").join(
        sets.select(F.col("id").alias("a"), F.col("_set").alias("_set_a")), "a"
    )
    return joined.select("a", "b", "_set_a", "_set_b").mapInArrow(run, "a long, b long")


def _near_in_size(n: Column, m: Column, percent: int) -> Column:
    return F.least(n, m) * 100 >= F.greatest(n, m) * percent


def star_pairs(postings: DataFrame, classes: DataFrame, matches: int, percent: int) -> DataFrame:
    """(``a``, ``b``): classes and the hub of a posting, agreeing in enough places.

    The hub is the class whose signature values are the most common: of many copies of one
    text, the text itself, to which all are nearer than to each other.
    """
    centres = postings.groupBy("token").agg(
        F.max(F.struct("hub", "id")).alias("c"), F.count(F.lit(1)).alias("many")
    )
    centres = staged(centres.where("many > 1").select("token", F.col("c.id").alias("a")), "minhash-hubs")
    pairs = (
        postings.join(centres, "token")
        .where("id != a")
        .select("a", F.col("id").alias("b"))
        .distinct()
    )

    def side(name: str) -> DataFrame:
        return classes.select(
            F.col("id").alias(name),
            F.col("n_shingles").alias(f"_n_{name}"),
            F.col("_signature").alias(f"_sig_{name}"),
        )

    same = F.size(
        F.filter(F.zip_with("_sig_a", "_sig_b", lambda x, y: x == y), lambda equal: equal)
    )
    return (
        pairs.join(side("b"), "b")
        .join(side("a"), "a")
        .where(_near_in_size(F.col("_n_a"), F.col("_n_b"), percent) & (same >= matches))
        .select("a", "b")
    )


_TILE = ("token", "_low", "_high")


def tiles(postings: DataFrame, labels: DataFrame, tile: int) -> DataFrame:
    """Members of the postings with several components, by tile (``token``, ``_low``, ``_high``).

    A posting is cut into blocks of about ``tile`` members, and every two blocks make a tile.
    """
    placed = postings.join(labels, "id", "left").withColumn("label", F.coalesce("label", "id"))
    mixed = (
        placed.groupBy("token")
        .agg(F.min("label").alias("_lo"), F.max("label").alias("_hi"), F.count(F.lit(1)).alias("_many"))
        .where("_lo < _hi")
        .select("token", F.ceil(F.col("_many") / tile).cast("int").alias("_tiles"))
    )
    mixed = staged(mixed, "minhash-mixed")
    block = F.pmod(F.xxhash64("id"), F.col("_tiles")).cast("int")
    members = placed.join(mixed, "token").withColumn("_block", block)
    # A member meets every block of its posting: once as the lower, once as the higher one.
    return members.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_tiles") - 1))).select(
        "token",
        F.least("_block", "_other").alias("_low"),
        F.greatest("_block", "_other").alias("_high"),
        "_block",
        "at",
        "id",
        "label",
    )


def _whole_tiles(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[pa.Table, list[int]]]:
    """Rows sorted by tile, as tables of whole tiles with the places where tiles begin and end."""
    rest = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        rows = rows if rest is None else pa.concat_tables([rest, rows])
        edges = _edges(rows)
        if len(edges) > 2:
            yield rows.slice(0, edges[-2]), edges[:-1]
        rest = rows.slice(edges[-2])
    if rest is not None and len(rest):
        yield rest, _edges(rest)


def _edges(rows: pa.Table) -> list[int]:
    new = np.zeros(len(rows), bool)
    new[:1] = True
    for name in _TILE:
        values = rows.column(name).to_numpy()
        new[1:] |= values[1:] != values[:-1]
    return [*np.flatnonzero(new).tolist(), len(rows)]


class _Tile:
    """Candidates among rows of whole tiles: across components, near in size and signature."""

    PAIRS = 1 << 18  # compared at a time

    def __init__(self, rows: pa.Table, matches: int, percent: int) -> None:
        self.matches, self.percent = matches, percent
        self.id, self.label, self.size, self.at, self.block, self.low, self.high, mask = (
            rows.column(c).to_numpy()
            for c in ("id", "label", "n_shingles", "at", "_block", "_low", "_high", "_mask")
        )
        flat = rows.column("_signature").combine_chunks().flatten().to_numpy()
        self.sig = flat.reshape(len(rows), -1)
        places = np.arange(self.sig.shape[1], dtype=np.int64)
        self.posted = (mask[:, None] >> places) & 1 == 1

    def _all(self, first: int, last: int) -> tuple[np.ndarray, np.ndarray]:
        if self.low[first] == self.high[first]:
            i, j = np.triu_indices(last - first, 1)
        else:
            lower = self.block[first:last] == self.low[first]
            left, right = np.flatnonzero(lower), np.flatnonzero(~lower)
            i, j = np.repeat(left, len(right)), np.tile(right, len(left))
        return i + first, j + first

    def candidates(self, edges: list[int]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(rows, other rows, places that agree), a few tiles at a time."""
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0
        for first, last in zip(edges, edges[1:]):
            if last - first < 2 or (self.label[first:last] == self.label[first]).all():
                continue
            held.append(self._all(first, last))
            size += len(held[-1][0])
            if size >= self.PAIRS:
                yield from self._near(held)
                held, size = [], 0
        yield from self._near(held)

    def _near(self, held: list) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        if not held:
            return
        i, j = (np.concatenate(x) for x in zip(*held))
        n, m = self.size[i], self.size[j]
        wanted = (self.label[i] != self.label[j]) & (
            100 * np.minimum(n, m) >= self.percent * np.maximum(n, m)
        )
        i, j = i[wanted], j[wanted]
        found = []
        for at in range(0, len(i), self.PAIRS):
            a, b = i[at : at + self.PAIRS], j[at : at + self.PAIRS]
            same = self.sig[a] == self.sig[b]
            count = same.sum(1)
            keep = count >= self.matches
            a, b, same, count = a[keep], b[keep], same[keep], count[keep]
            # A pair meets in every pair (coordinate, value) both post; it counts in the first.
            here = (same & self.posted[a] & self.posted[b]).argmax(1) == self.at[a]
            found.append((a[here], b[here], count[here]))
        if found:
            yield tuple(np.concatenate(x) for x in zip(*found))


def _sorted_by_tile(rows: DataFrame) -> DataFrame:
    return rows.repartition(*_TILE).sortWithinPartitions(*_TILE)


def tile_links(
    dealt: DataFrame, classes: DataFrame, sets: DataFrame, matches: int, percent: int
) -> DataFrame:
    """Links (``a``, ``b``) across components among the members of tiles.

    First the members that have a candidate in a tile are found by signature; only their sets
    are brought there, and candidates are confirmed in place. Once two components are linked in
    a tile, their other pairs need no answer, so a tile yields fewer links than it has members.
    """
    signed_rows = dealt.join(classes.select("id", "n_shingles", "_mask", "_signature"), "id")

    def needed(batches):
        let_go()
        for rows, edges in _whole_tiles(batches):
            tile = _Tile(rows, matches, percent)
            hit = np.zeros(len(rows), bool)
            for i, j, _ in tile.candidates(edges):
                hit[i] = hit[j] = True
            yield from rows.filter(pa.array(hit)).to_batches(max_chunksize=10_000)

    asked = _sorted_by_tile(signed_rows).mapInArrow(needed, signed_rows.schema)
    ready = staged(asked, "minhash-asked").join(sets, "id")

    def linked(batches):
        let_go()
        for rows, edges in _whole_tiles(batches):
            tile = _Tile(rows, matches, percent)
            shingles = rows.column("_set").to_pylist()
            where = np.searchsorted(edges, np.arange(len(rows)), "right")
            links: list[tuple[int, int]] = []
            for i, j, count in tile.candidates(edges):
                parent: dict[tuple[int, int], tuple[int, int]] = {}

                def root(x):
                    while x in parent:
                        x = parent[x]
                    return x

                for n in np.argsort(-count, kind="stable").tolist():
                    a, b = int(i[n]), int(j[n])
                    x = root((int(where[a]), int(tile.label[a])))
                    y = root((int(where[b]), int(tile.label[b])))
                    if x != y and similar(shingles[a], shingles[b], percent):
                        parent[x] = y
                        links.append((int(tile.id[a]), int(tile.id[b])))
            yield pa.RecordBatch.from_arrays(
                [pa.array([x for x, _ in links], pa.int64()), pa.array([y for _, y in links], pa.int64())],
                names=["a", "b"],
            )

    return _sorted_by_tile(ready).mapInArrow(linked, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """(``id``, ``label``): the smallest id reachable, for every end of an edge (``a``, ``b``).

    Each turn passes labels over the edges, to the node and to the node its label names, and
    follows labels one step; the number of turns grows with the logarithm of the longest path.
    """
    both = staged(edges.unionAll(edges.select("b", "a")).distinct(), "edges")
    nearest = both.groupBy("a").agg(F.min("b").alias("b"))
    labels = staged(nearest.select(F.col("a").alias("id"), F.least("a", "b").alias("label")), "labels")
    while True:
        near = (
            both.join(labels.withColumnRenamed("id", "b"), "b")
            .groupBy(F.col("a").alias("id"))
            .agg(F.min("label").alias("near"))
        )
        seen = labels.join(near, "id")
        told = (
            seen.select("id", F.least("label", "near").alias("label"))
            .unionAll(seen.select(F.col("label").alias("id"), F.col("near").alias("label")))
            .groupBy("id")
            .agg(F.min("label").alias("label"))
        )
        told = staged(told, "labels")
        parent = told.select(F.col("id").alias("label"), F.col("label").alias("_next"))
        jumped = staged(told.join(parent, "label").select("id", F.col("_next").alias("label")), "labels")
        changed = jumped.join(labels.withColumnRenamed("label", "_old"), "id").where("label != _old")
        if changed.isEmpty():
            return jumped
        labels = jumped


def report(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    words: int = WORDS,
    percent: int = PERCENT,
    coordinates: int = COORDINATES,
    matches: int = MATCHES,
    tile: int = TILE,
) -> DataFrame:
    """One row per document: ``doc_id``, ``n_shingles``, ``component_id``, ``kept``.

    Texts without words (null, empty) have no shingles and stay alone. Null keys take part in
    links but never name a component that has another key; repeated rows share a component. An
    empty table gives no rows.
    """
    place = free_name(docs, "_place")
    placed = docs.withColumn(place, F.lit(0).cast("long"))
    found = _judged(placed, key, text, place, words, percent, coordinates, matches, tile)
    kept = F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept")
    return found.select("doc_id", "n_shingles", "component_id", kept)


def _judged(
    docs: DataFrame, key: str, text: str, place: str,
    words: int = WORDS, percent: int = PERCENT, coordinates: int = COORDINATES,
    matches: int = MATCHES, tile: int = TILE,
) -> DataFrame:
    """Every row's ``_ROW``, ``n_shingles``, ``component_id`` and whether it ``stays``.

    The first of a component by (null key last, key, text hash, ``place``) stays.
    """
    rows = docs.select(
        F.col(key).alias("doc_id"), text_of(text).alias("text"), F.col(place).alias("_place")
    )
    rows = rows.withColumn("_mark", F.xxhash64("text"))
    documents = staged(signed(rows, words, coordinates), "minhash-documents")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), *_ROW))
    classes = (
        documents.where(F.col("_class").isNotNull())
        .groupBy("_class")
        .agg(
            first.alias("_first"),
            F.first("n_shingles").alias("n_shingles"),
            F.first("_signature").alias("_signature"),
        )
        .select("_class", "_first", "_first.doc_id", "_first._mark", "n_shingles", "_signature")
    )
    classes = staged(classes.withColumn("id", F.monotonically_increasing_id()), "minhash-classes")
    labels = _labels(rows, classes, words, percent, matches, tile)
    named = classes.select("_class", "id", "_first").join(labels, "id", "left")
    named = named.withColumn("label", F.coalesce("label", "id"))
    least = named.groupBy("label").agg(F.min("_first").alias("_least"))
    of_class = staged(named.join(least, "label").select("_class", "_least"), "minhash-result")
    joined = documents.join(of_class, "_class", "left")
    alone = F.col("_class").isNull()
    same = F.lit(True)
    for name in _ROW:
        same = same & F.col(name).eqNullSafe(F.col(f"_least.{name}"))
    return joined.select(
        *_ROW,
        "n_shingles",
        F.when(alone, F.col("doc_id")).otherwise(F.col("_least.doc_id")).alias("component_id"),
        (alone | same).alias("stays"),
    )


def _labels(
    rows: DataFrame, classes: DataFrame, words: int, percent: int, matches: int, tile: int
) -> DataFrame:
    tokens = classes.select("id", F.posexplode("_signature").alias("at", "value")).select(
        "id", "at", (F.shiftleft(F.col("at").cast("long"), 32) + F.col("value")).alias("token")
    )
    # Small sides of joins are read from tables: they have no partitioning of their own then, so
    # both sides are shuffled for the join and Spark may split a frequent token or a large class.
    counts = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("many")).where("many > 1")
    counts = staged(counts, "minhash-counts")
    held = (
        tokens.join(counts, "token")
        .groupBy("id")
        .agg(F.array_sort(F.collect_list(F.struct("many", "token", "at"))).alias("held"))
        .where(F.size("held") >= matches)
    )
    prefix = F.slice("held", F.lit(1), F.size("held") - (matches - 1))
    posted = staged(
        held.select(
            "id",
            F.aggregate("held", F.lit(0).cast("long"), lambda total, t: total + t["many"]).alias("hub"),
            F.transform(prefix, lambda t: F.struct(t["token"], t["at"])).alias("prefix"),
        ),
        "minhash-posted",
    )
    postings = posted.select("id", "hub", F.inline("prefix"))
    mask = F.expr("aggregate(prefix, 0L, (bits, t) -> bits | shiftleft(1L, t.at))").alias("_mask")
    some = staged(classes.join(posted.select("id", mask), "id"), "minhash-some")
    star = staged(star_pairs(postings, some, matches, percent), "minhash-star")
    # Sets are made again for the classes posted, from the row that stands for the class.
    marks = some.select(F.col("doc_id").alias("_id"), F.col("_mark").alias("_m")).hint("shuffle_hash")
    chosen = rows.join(
        marks, (F.col("_mark") == F.col("_m")) & F.col("doc_id").eqNullSafe(F.col("_id")), "left_semi"
    )
    sets = full_sets(chosen, words).dropDuplicates(["_class"])
    sets = staged(sets.join(some.select("_class", "id"), "_class").select("id", "_set"), "minhash-sets")
    links = staged(confirmed(star, sets, percent), "minhash-links")
    labels = components(links)
    dealt = tiles(postings, labels, tile)
    more = staged(tile_links(dealt, some, sets, matches, percent), "minhash-more")
    if more.isEmpty():
        return labels
    return components(links.unionAll(more))


def deduplicated(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` with one document of each component; columns as they were.

    Keys may repeat or be null: rows go by key and text, those without a key by row. Rows that
    repeat both the key and the text of the document that stays all stay; ``exact`` removes these.
    """
    place, mark, gone_id, gone_mark, gone_place = (
        free_name(docs, f"_{name}") for name in ("place", "text_mark", "gone_id", "gone_mark", "gone_place")
    )
    # Only rows without a key need numbers, so only they are written.
    unnamed = docs.where(F.col(key).isNull()).withColumn(place, F.monotonically_increasing_id() + 1)
    named = docs.where(F.col(key).isNotNull()).withColumn(place, F.lit(0).cast("long"))
    placed = named.unionAll(staged(unnamed, "minhash-unnamed"))
    gone = _judged(placed, key, text, place, **options).where(~F.col("stays"))
    gone = gone.select(*_ROW).distinct().toDF(gone_id, gone_mark, gone_place)
    marked = placed.withColumn(mark, F.xxhash64(text_of(text)))
    same = (
        F.col(key).eqNullSafe(F.col(gone_id))
        & (F.col(mark) == F.col(gone_mark))
        & (F.col(place) == F.col(gone_place))
    )
    return marked.join(gone, same, "left_anti").select(*docs.columns)
