import random
from collections import defaultdict

import numpy as np
from tokenizers import Tokenizer

from edgeframe.llm import packing
from edgeframe.llm.common import staged


def test_tightest_bin_is_taken_and_the_fullest_closes():
    bins = packing.OpenBins(10, 2)
    assert bins.place(6) == (0, 0)  # free 4
    assert bins.place(7) == (1, 0)  # free 3
    assert bins.place(3) == (1, 7)  # fits both; the tighter one, which is then full
    assert bins.place(8) == (2, 0)  # free 4 and 2
    assert bins.place(5) == (3, 0)  # none fits and two are open: the one with 2 free closes
    assert sorted(bins.open()) == [(0, 4), (3, 5)]
    assert bins.place(10) == (4, 0)


def test_against_a_search_of_all_open_bins():
    rng = random.Random(1)
    bins, plain = packing.OpenBins(50, 5), {}
    for n in (rng.randint(1, 50) for _ in range(2000)):
        name, offset = bins.place(n)
        fitting = [f for f in plain.values() if f >= n]
        if fitting:
            assert plain[name] == min(fitting)
            assert offset == 50 - plain[name]
        else:
            assert name not in plain and offset == 0
            if len(plain) == 5:
                del plain[next(k for k, f in plain.items() if f == min(plain.values()) and k not in dict(bins.open()))]
            plain[name] = 50
        plain[name] -= n
        if not plain[name]:
            del plain[name]
        assert dict(bins.open()) == plain


def _check(rows, size):
    bins = defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= size
    return len(bins)


def test_every_piece_is_placed(spark, frame, prose, vocabulary_path, odd):
    library = Tokenizer.from_file(vocabulary_path)
    rows = odd + [(100 + i, prose(5 + 13 * (i % 30), i)) for i in range(120)] + [(999, prose(900, 3))]
    packed = packing.pack(frame(rows), vocabulary_path, size=128, group_rows=64, with_ids=True).cache()
    found = packed.collect()
    used = _check(found, 128)
    assert used <= 1.02 * sum(r.length for r in found) / 128 + 2
    whole = defaultdict(list)
    for r in sorted(found, key=lambda r: (r.start, r.piece)):
        whole[r.doc_id].append(r)
    for key, text in rows:
        if key is None or key == 4:
            continue
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 1]
        assert [i for r in whole[key] for i in r.ids] == ids
        assert [r.start for r in whole[key]] == list(range(0, len(ids), 128))
        for r in whole[key]:
            import zlib

            assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
            assert (r.length == 128) or r.start + r.length == len(ids)
    assert len(whole[4]) == 2 and len(whole[None]) == 2
    lines = packing.sequences(packed).collect()
    assert sum(len(r.ids) for r in lines) == sum(r.length for r in found)


def test_rounds_leave_one_group_of_open_bins(spark):
    rng = random.Random(3)
    sizes = spark.createDataFrame([(i, rng.randint(1, 99)) for i in range(3000)], "_row long, length long")
    placed = packing.place(staged(sizes, "t"), size=100, open_bins=50, group_rows=100)
    rows = placed.join(sizes, "_row").collect()
    assert len(rows) == 3000 == len({r._row for r in rows})
    used = _check(rows, 100)
    assert used <= 1.06 * sum(r.length for r in rows) / 100


def test_empty_table(frame, vocabulary_path):
    assert packing.pack(frame([(1, "a")]).where("false"), vocabulary_path).count() == 0
