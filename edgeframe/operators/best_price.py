"""The best price over venues at every quote, for whole batches of blocks at a time.

A quote stands from its row until the next quote of its venue, or the end of its block: an
interval. The best price at a row is the least of the intervals that hold it, and it is found
for all rows together: an interval is covered by two overlapping ranges of the largest power of
two that fits; ranges of each length keep their least value, and pass it on to the two ranges of
half the length, down to single rows. That takes one pass per power of two, for any number of
venues. Price and venue name make one number, so that the smallest name wins a tie.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Rows of a block: quotes that do not change the book and that do, last quotes before the block
#: of venues that quote in it, and the best of all other venues.
OTHER, QUOTE, SEED, BASE = -1, 0, 1, 2
STATE = "best_ask double, best_bid double, venue_count int, ask_venue string, bid_venue string"

_NONE = np.iinfo(np.int64).max


def least_over(start: np.ndarray, stop: np.ndarray, value: np.ndarray, size: int) -> np.ndarray:
    """For each place below ``size`` the least value of the intervals [start, stop) that hold it."""
    least = np.full(size, _NONE, np.int64)
    if not len(start):
        return least
    level = np.frexp((stop - start).astype(float))[1] - 1
    for k in range(int(level.max()), -1, -1):
        half = 1 << k
        # From ranges of 2 * half rows to those of half: the first half, and the second.
        if half < size:
            least[half:] = np.minimum(least[half:], least[:-half]) if k < int(level.max()) else least[half:]
        some = level == k
        np.minimum.at(least, start[some], value[some])
        np.minimum.at(least, stop[some] - half, value[some])
    return least


class _Side:
    """Asks (``sign`` 1) or bids (-1) as numbers that order by price, then name."""

    def __init__(self, prices: np.ndarray, sign: int, names: int) -> None:
        self.sign, self.names = sign, max(1, names)
        self.prices = np.unique(prices[~np.isnan(prices)] * sign)

    def coded(self, prices: np.ndarray, names: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.prices, prices * self.sign) * self.names + names

    def read(self, coded: np.ndarray, names: pa.Array) -> tuple[pa.Array, pa.Array]:
        none = coded == _NONE
        at = np.where(none, 0, coded)
        if not len(self.prices):
            return pa.nulls(len(coded), pa.float64()), pa.nulls(len(coded), pa.string())
        prices = pa.array(self.prices[at // self.names] * self.sign, mask=none)
        return prices, names.take(pa.array(at % self.names, mask=none))


def book(groups: np.ndarray, table: pa.Table) -> list[pa.Array]:
    """The state columns of ``table``, whose rows are blocks one after another, in order.

    ``groups`` numbers the blocks; a block's ``BASE`` and ``SEED`` rows come before its quotes.
    """
    size = len(groups)
    kind = table["_kind"].to_numpy()
    bids, asks = (table[c].combine_chunks().cast(pa.float64()).to_numpy(zero_copy_only=False) for c in ("yes_bid", "yes_ask"))
    venue, other = (table[c].combine_chunks().cast(pa.string()) for c in ("venue", "_other"))
    names = pc.unique(pa.concat_arrays([venue, other])).drop_null()
    names = names.take(pc.sort_indices(names))
    venue, other = (pc.fill_null(pc.index_in(v, names), -1).to_numpy().astype(np.int64) for v in (venue, other))
    base = np.flatnonzero(kind == BASE)
    moves = np.flatnonzero((kind == SEED) | (kind == QUOTE))

    # A quote stands until the next of its venue in the block, or the end of the block.
    order = moves[np.lexsort((moves, venue[moves], groups[moves]))]
    same = np.zeros(len(order), bool)
    same[1:] = (np.diff(groups[order]) == 0) & (np.diff(venue[order]) == 0)
    ends = np.searchsorted(groups, groups[order], "right")
    stop = np.where(np.append(same[1:], False), np.append(order[1:], 0), ends)

    columns = []
    for prices, sign, owner in ((asks, 1, venue), (bids, -1, other)):
        side = _Side(prices, sign, len(names))
        found = least_over(order, stop, side.coded(prices[order], venue[order]), size)
        some = base[~np.isnan(prices[base])]
        standing = np.full(int(groups[-1]) + 1, _NONE, np.int64)
        standing[groups[some]] = side.coded(prices[some], owner[some])
        columns.append(side.read(np.minimum(found, standing[groups]), names))

    fresh = np.zeros(size, np.int64)
    fresh[order[~same]] = kind[order[~same]] == QUOTE
    total = np.cumsum(fresh)
    first = np.searchsorted(groups, groups)
    seen = np.zeros(int(groups[-1]) + 1, np.int64)
    seen[groups[base]] = pc.fill_null(table["_seen"], 0).to_numpy()[base]
    count = seen[groups] + total - (total[first] - fresh[first])
    (ask, ask_venue), (bid, bid_venue) = columns
    return [ask, bid, pa.array(count, pa.int32()), ask_venue, bid_venue]


def _numbered(table: pa.Table, place: Sequence[str]) -> np.ndarray:
    """The number of the block of each row; a block is where ``place`` stays the same."""
    change = np.zeros(len(table), bool)
    for name in place:
        codes = table[name].combine_chunks().dictionary_encode("encode").indices.to_numpy(zero_copy_only=False)
        change[1:] |= np.diff(codes) != 0
    return np.cumsum(change)


def states(names: Sequence[str], place: Sequence[str], crossed: bool = False) -> Callable[[Iterator], Iterator[pa.RecordBatch]]:
    """For sorted batches, ``names`` of the quotes with the state after each.

    Whole blocks are handled as they become complete, so at most one block and a batch are held.
    ``crossed`` keeps only rows whose best bid is above the best ask.
    """
    fields = [f.strip().split()[0] for f in STATE.split(",")]

    def finished(parts: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not parts:
            return
        table = pa.Table.from_batches(parts).combine_chunks()
        state = book(_numbered(table, place), table)
        whole = pa.table([*(table[n] for n in names), *state], names=[*names, *fields])
        wanted = pc.less_equal(table["_kind"], QUOTE)
        if crossed:
            wanted = pc.and_(wanted, pc.fill_null(pc.greater(whole["best_bid"], whole["best_ask"]), False))
        yield from whole.filter(wanted).to_batches()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not len(batch):
                continue
            groups = _numbered(pa.Table.from_batches([batch]), place)
            last = int(np.searchsorted(groups, groups[-1]))  # where the last block begins
            if last:
                yield from finished([*held, batch.slice(0, last)])
                held = [batch.slice(last)]
                continue
            if held and any(held[-1][n][-1] != batch[n][0] for n in place):
                yield from finished(held)
                held = []
            held.append(batch)
        yield from finished(held)

    return run
