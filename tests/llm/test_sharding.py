import zlib
from collections import defaultdict

from edgeframe.llm import sharding


def _check(found, rows, shards):
    assert len(found) == len(rows)
    total = sum(r.size for r in found)
    by_shard = defaultdict(list)
    for r in found:
        by_shard[r.shard].append(r)
    assert all(0 <= s < shards for s in by_shard)
    largest = max(r.size for r in found)
    order = []
    for shard in sorted(by_shard):
        members = sorted(by_shard[shard], key=lambda r: r.slot)
        assert [r.slot for r in members] == list(range(len(members)))
        order += members
        at = sum(r.size for s in sorted(by_shard) if s <= shard for r in by_shard[s])
        assert abs(at - total * (shard + 1) / shards) <= max(largest, total / shards)
    keys = [(r.doc_id is not None, r.doc_id or 0) for r in order]
    assert keys == sorted(keys)


def test_contiguous_and_balanced(frame, prose, odd):
    rows = odd + [(100 + i, "é" * (i % 17) + prose(i % 50, i)) for i in range(600)]
    found = sharding.report(frame(rows, parts=5)).collect()
    _check(found, rows, 16)
    texts = {r[0]: r[1] or "" for r in rows if r[0] is not None}
    for r in found:
        assert r.law == "bytes" and r.grown_shard is None
        if r.doc_id is not None:
            assert r.size == len(texts[r.doc_id].encode()) + 1
            assert r.text_crc32 == zlib.crc32(texts[r.doc_id].encode())
    sizes = defaultdict(int)
    for r in found:
        sizes[r.shard] += r.size
    assert max(sizes.values()) - min(sizes.values()) <= 2 * max(r.size for r in found)


def test_small_blocks_give_the_same(frame, prose):
    docs = frame([(i, prose(i % 9, i)) for i in range(300)], parts=4)
    wanted = sorted(map(tuple, sharding.sharded(docs).collect()))
    assert sorted(map(tuple, sharding.sharded(docs, block=8).collect())) == wanted


def test_one_large_row_and_hot_key(frame):
    rows = [(1, "x" * 100_000)] + [(7, "abc")] * 200 + [(9, "z")]
    found = sharding.report(frame(rows)).collect()
    assert len(found) == 202
    by_shard = defaultdict(list)
    for r in found:
        by_shard[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in by_shard.values())


def test_empty_and_writing(spark, frame, fresh):
    docs = frame([(i, "t" * i) for i in range(50)])
    assert sharding.report(docs.where("false")).count() == 0
    path = fresh("shards")
    sharding.write_shards(docs, path, shards=4)
    back = spark.read.parquet(path)
    assert back.count() == 50 and set(docs.columns) < set(back.columns)
    assert back.select("_shard").distinct().count() == 4
