import math
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from edgeframe.llm import mixing

FIELDS = "doc_id long, text string, source string, size int, target string, _rank int"


@pytest.fixture
def documents(spark):
    def make(rows, parts=3):
        return spark.createDataFrame([(i, t, s, 1, "x", None) for i, t, s in rows], FIELDS).repartition(parts)

    return make


def _targets(sizes):
    """Sizes of sources in order -> targets, sharing the excess again and again."""
    weights = {s: (3, 1, 2)[i % 3] for i, s in enumerate(sizes)}
    left, target, free = 1.5 * sum(sizes.values()), dict.fromkeys(sizes, 0.0), set(sizes)
    while left > 1e-9 and free:
        share = left / sum(weights[s] for s in free)
        left = 0.0
        for s in list(free):
            target[s] += share * weights[s]
            if target[s] > 2 * sizes[s]:
                left += target[s] - 2 * sizes[s]
                target[s] = 2 * sizes[s]
                free.remove(s)
    return target


def _rows():
    import random

    rng = random.Random(3)
    rows = []
    for i in range(260):
        source = rng.choice(["a"] * 9 + ["b", "C", "ä", "ü", None])
        rows.append((i, " ".join(f"w{i}x{k}" for k in range(rng.choice([0, 3, 40, 700]))), source))
    return rows + [(900, "long " * 6000, "b"), (901, None, "a"), (902, " \n", None), (3, "same", "e"), (3, "same", "e"), (None, "x y", "e")]


def test_targets_and_taken(documents):
    rows = _rows()
    found = mixing.report(documents(rows)).collect()
    assert len(found) == len(rows)
    count = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes = defaultdict(int)
    for _, t, s in sorted(rows, key=lambda r: (r[2] is None, r[2] or "")):
        sizes[s] += count(t)
    want = _targets(sizes)
    expected = Counter((i, count(t), sizes[s]) for i, t, s in rows)
    assert Counter((r.doc_id, r.size, r.source_size) for r in found) == expected
    taken = defaultdict(int)
    by_size = {size: s for s, size in sizes.items()}
    assert len(by_size) == len(sizes)
    for r in found:
        source = by_size[r.source_size]
        assert r.target == pytest.approx(want[source], rel=1e-12)
        assert 0 <= r.taken <= 2 * r.size
        taken[source] += r.taken
    assert {s: taken[s] for s in sizes} == {s: math.floor(want[s] + 1e-9) for s in sizes}
    again = mixing.report(documents(rows, 7)).collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, found))


def test_shards_hold_disjoint_blocks_of_all_that_is_taken(documents):
    rows = [r for r in _rows() if r[0] not in (3, None)]
    docs = documents(rows)
    shards = mixing.shards_of_text(docs, block=50, shards=5, seed=2).collect()
    words = Counter(w for r in shards for w in r.text.split() if w != "long")
    assert max(words.values()) <= 2
    report = {r.doc_id: r.taken for r in _report(docs, 50, 5, 2)}
    per_doc = Counter()
    for w, n in words.items():
        if re.fullmatch(r"w\d+x\d+", w):
            per_doc[int(w[1:].split("x")[0])] += n
    for i, t, _ in rows:
        if i < 900:
            assert per_doc[i] == report[i]
    for shard in range(5):
        own = [r for r in shards if r.shard == shard]
        assert sorted(r.slot for r in own) == list(range(len(own)))
    counts = Counter(r.shard for r in shards)
    assert max(counts.values()) - min(counts.values()) <= 1
    assert all(len(r.text.split()) <= 50 for r in shards)


def _report(docs, block, shards, seed):
    mixed = mixing.mix(docs, block=block, shards=shards, seed=seed)
    part = F.greatest(F.least("_end", "_take") - F.col("_first"), F.lit(0))
    taken = mixed.pieces.join(mixed.blocks, ["_rank", "_nr_block"]).groupBy("_row").agg(F.sum(part).alias("taken"))
    return mixed.docs.join(taken, "_row", "left").na.fill(0, ["taken"]).collect()


def test_draws_follow_the_distribution(spark):
    good, bad, draws = 9, 14, 7
    frame = spark.range(20000).select(
        mixing.hypergeometric(
            F.lit(good).cast("long"), F.lit(bad).cast("long"), F.lit(draws).cast("long"), (F.col("id") + 0.5) / 20000
        ).alias("x")
    )
    found = {r.x: r["count"] / 20000 for r in frame.groupBy("x").count().collect()}
    for x in range(draws + 1):
        p = math.comb(good, x) * math.comb(bad, draws - x) / math.comb(good + bad, draws)
        assert found.get(x, 0) == pytest.approx(p, abs=1e-4)
    edge = [(0, 5, 3, 0), (5, 0, 3, 3), (4, 4, 8, 4), (4, 4, 0, 0), (0, 0, 0, 0)]
    rows = spark.createDataFrame(edge, "g long, b long, m long, x long")
    got = rows.select("x", mixing.hypergeometric(F.col("g"), F.col("b"), F.col("m"), F.lit(0.7)).alias("y")).collect()
    assert all(r.x == r.y for r in got)
    big = spark.range(200).select(
        mixing.hypergeometric(*[F.lit(v).cast("long") for v in (4_000_000, 6_000_000, 5_000_000)], (F.col("id") + 0.5) / 200).alias("x")
    )
    mean, sd = big.agg(F.avg("x"), F.stddev("x")).first()
    assert mean == pytest.approx(2_000_000, abs=100) and sd == pytest.approx(774.6, rel=0.05)


@pytest.mark.parametrize("shards", [1, 3, 16])
def test_quotas_are_split_exactly(spark, shards, monkeypatch):
    monkeypatch.setattr(mixing, "FAN", 4)  # several levels of groups of sources
    quotas = [(r, 37 * (r % 7)) for r in range(21)]
    frame = spark.createDataFrame(quotas, "_rank long, _n long").where("_n > 0")
    found = mixing.split_quotas(frame, shards, 5).collect()
    per_source, per_shard = Counter(), Counter()
    for r in found:
        assert r._n >= 0
        per_source[r._rank] += r._n
        per_shard[r.shard] += r._n
    assert per_source == Counter({r: n for r, n in quotas if n})
    assert len(per_shard) == shards and max(per_shard.values()) - min(per_shard.values()) <= 1


def test_empty_tables(documents):
    assert mixing.report(documents([(1, "a", "s")]).where("false")).count() == 0
    rows = mixing.report(documents([(1, None, "s"), (2, "", None)])).collect()
    assert [(r.size, r.source_size, r.target, r.taken) for r in rows] == [(0, 0, 0.0, 0)] * 2
