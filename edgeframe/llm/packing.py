"""Best-fit packing of documents into token sequences, with a fixed number of open bins.

Bins are found by their free space: a bitset has a bit for every free space that some open bin
has, so the tightest bin that fits is the lowest set bit at or above the piece's size. If none
fits and all bins are in use, the fullest one closes.

Pieces are dealt by a hash into groups of bounded size and packed independently, the longest
first, so that short ones fill the gaps that long ones leave. A group ends with bins that are still open; the pieces of those with room left are dealt again into fewer
groups, until one group is left, so the number of half-filled sequences does not grow with the
number of groups.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from edgeframe.llm.bpe import codec, read_vocabulary
from edgeframe.llm.common import staged

SIZE = 4096
END_ID = 1
#: Bins a group keeps open.
OPEN_BINS = 4096
#: Pieces of a group, on average.
GROUP_ROWS = 8192


class OpenBins:
    """A fixed number of open bins, by free space."""

    def __init__(self, size: int, limit: int) -> None:
        self.size, self.limit = size, limit
        self.count = self.total = 0
        self._bits = 0  # bit f: some open bin has f places free
        self._at: list[list[int]] = [[] for _ in range(size + 1)]

    def _take(self, free: int) -> int:
        name = self._at[free].pop()
        if not self._at[free]:
            self._bits &= ~(1 << free)
        self.count -= 1
        return name

    def place(self, length: int) -> tuple[int, int]:
        """Bin and offset for a piece of ``length``."""
        fitting = self._bits >> length
        if fitting:
            free = length + (fitting & -fitting).bit_length() - 1
            name = self._take(free)
        else:
            if self.count >= self.limit:
                self._take((self._bits & -self._bits).bit_length() - 1)
            free, name = self.size, self.total
            self.total += 1
        left = free - length
        if left:
            self._at[left].append(name)
            self._bits |= 1 << left
            self.count += 1
        return name, self.size - free

    def open(self) -> Iterator[tuple[int, int]]:
        """Open bins with their free space."""
        for free, names in enumerate(self._at):
            for name in names:
                yield name, free


def cut(ends: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document, piece, start, length) of all pieces of documents that begin at ``ends[:-1]``."""
    lengths = np.diff(ends)
    counts = -(-lengths // size)
    document = np.repeat(np.arange(len(lengths)), counts)
    piece = np.arange(len(document)) - np.repeat(np.cumsum(counts) - counts, counts)
    start = piece * size
    return document, piece, start, np.minimum(size, lengths[document] - start)


def pieces(
    docs: DataFrame,
    path: str,
    size: int = SIZE,
    end_id: int = END_ID,
    key: str = "doc_id",
    text: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """The pieces of every document: its ids and ``end_id``, cut at ``size``.

    Null and empty texts are a piece of one token. ``with_ids`` adds the ids of each piece.
    """
    vocabulary = docs.sparkSession.sparkContext.broadcast(read_vocabulary(path))
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).cast("string").alias("text"))
    schema = rows.select("doc_id").schema.add("piece", T.IntegerType())
    for name in ("start", "length", "ids_crc32"):
        schema = schema.add(name, T.LongType())
    if with_ids:
        schema = schema.add("ids", T.ArrayType(T.IntegerType()))

    def run(batches):
        encoder, _ = codec(vocabulary.value)
        for batch in batches:
            at = 0
            for flat, ends in encoder.encode_array(batch.column(1)):
                # Every document gets its last id, all pieces lie end to end.
                flat = np.insert(flat, ends[1:], end_id).astype(np.int32)
                ends = ends + np.arange(len(ends))
                document, piece, start, length = cut(ends, size)
                data = memoryview(flat.astype("<u4")).cast("B")
                cuts = np.append(4 * (ends[document] + start), 4 * ends[-1]).tolist()
                columns = [
                    batch.column(0).take(pa.array(document + at)),
                    pa.array(piece, pa.int32()),
                    pa.array(start, pa.int64()),
                    pa.array(length, pa.int64()),
                    pa.array([zlib.crc32(data[a:b]) for a, b in zip(cuts, cuts[1:])], pa.int64()),
                ]
                if with_ids:
                    bounds = pa.array(np.append(ends[document] + start, ends[-1]), pa.int32())
                    columns.append(pa.ListArray.from_arrays(bounds, pa.array(flat)))
                at += len(ends) - 1
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return rows.mapInArrow(run, schema)


def _packer(size: int, open_bins: int, final: bool, spare: int):
    """A function packing one group; rows of bins that may be packed again are marked."""

    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "_deal", "_row"], ascending=[False, True, True])
        bins = OpenBins(size, open_bins)
        placed = np.array([bins.place(n) for n in rows["length"].tolist()], np.int64).reshape(-1, 2)
        again = np.zeros(bins.total, bool)
        if not final:
            again[[name for name, free in bins.open() if free > spare]] = True
        return pd.DataFrame(
            {
                "_row": rows["_row"].to_numpy(),
                "length": rows["length"].to_numpy(),
                "sequence_id": (rows["_group"].to_numpy() << 32) + placed[:, 0],
                "offset": placed[:, 1],
                "_again": again[placed[:, 0]],
            }
        )

    return pack


PLACED = "_row long, length long, sequence_id long, offset long, _again boolean"


def place(
    sizes: DataFrame,
    size: int = SIZE,
    open_bins: int = OPEN_BINS,
    group_rows: int = GROUP_ROWS,
    spare: int | None = None,
) -> DataFrame:
    """(``_row``, ``sequence_id``, ``offset``) for rows of (``_row``, ``length`` below ``size``).

    Rounds go on until one group is left; every round is written to the shared folder. Bins with
    at most ``spare`` (1 % of ``size``) places free are not packed again.
    """
    spare = size // 100 if spare is None else spare
    placed, left, turn = [], sizes, 0
    count = sizes.count()
    groups = max(1, -(-count // group_rows))
    while True:
        # Which bins share a group changes from round to round, and not with repeated tasks.
        dealt = left.withColumn("_deal", F.xxhash64("_row", F.lit(turn))).withColumn(
            "_group", F.pmod("_deal", F.lit(groups)) + (turn << 24)
        )
        packer = _packer(size, open_bins, groups == 1, spare)
        done = staged(dealt.groupBy("_group").applyInPandas(packer, PLACED), f"packed-{turn}")
        placed.append(done.where(~F.col("_again")))
        if groups == 1:
            break
        left = done.where("_again").select("_row", "length")
        # Few rows come back, but at least one group less, so that the rounds end.
        groups = max(1, min(groups - 1, -(-left.count() // group_rows)))
        turn += 1
    result = placed[0]
    for more in placed[1:]:
        result = result.unionByName(more)
    return result.select("_row", "sequence_id", "offset")


def pack(
    docs: DataFrame,
    path: str,
    size: int = SIZE,
    end_id: int = END_ID,
    open_bins: int = OPEN_BINS,
    group_rows: int = GROUP_ROWS,
    key: str = "doc_id",
    text: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """All pieces of all documents with their sequence and offset there.

    Sequences have at most ``size`` tokens and no gaps. Null and empty texts take one place
    (``end_id``); a null key stays null; repeated rows are packed once each; an empty table
    gives no rows. ``with_ids`` keeps the token ids, from which ``sequences`` builds the rows
    of a training set.
    """
    cuts = pieces(docs, path, size, end_id, key, text, with_ids)
    cuts = staged(cuts.withColumn("_row", F.monotonically_increasing_id()), "pieces")
    short = cuts.where(F.col("length") < size).select("_row", "length")
    own = cuts.select("_row", "length").where(F.col("length") == size)
    # A full piece is a sequence of its own; its number lies outside those of the groups.
    own = own.select("_row", (-1 - F.col("_row")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    places = place(short, size, open_bins, group_rows).unionByName(own)
    return cuts.join(places, "_row").drop("_row")


def sequences(packed: DataFrame) -> DataFrame:
    """(``sequence_id``, ``ids``): the tokens of each sequence; at most a sequence in a group."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids"))
