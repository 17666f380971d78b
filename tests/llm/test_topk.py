import math
import random

import numpy as np
from pyspark.sql import functions as F

from edgeframe.llm import topk


def _expected(rows, k=5):
    usable = []
    for key, vector in rows:
        if key is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        usable.append((key, tuple(math.floor(256 * float(np.float32(x))) for x in vector)))
    out = []
    for key, query in sorted(set(u for u in usable if u[0] % 10 == 0)):
        scores = sorted(
            (-max(-(2**63), min(2**63 - 1, sum(a * b for a, b in zip(query, v)))), i)
            for i, v in usable
            if i != key and len(v) == len(query)
        )
        out += [(key, n + 1, i, -s) for n, (s, i) in enumerate(scores[:k])]
    return sorted(out)


def _frame(spark, rows, parts=4):
    return spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<float>, score int").repartition(parts)


def _search(frame, **options):
    return sorted(map(tuple, topk.search(frame, F.col("vec_id") % 10 == 0, **options).collect()))


def _rows():
    rng = random.Random(2)
    rows = [(i, [rng.choice([-1.5, -0.25, 0.0, 0.003, 0.5, 1.0]) for _ in range(4)]) for i in range(120)]
    rows += [(200 + i, [0.5, 0.5, 0.5, 0.5]) for i in range(40)]  # ties
    rows += [(31, rows[31][1]), (31, rows[31][1]), (20, rows[20][1])]  # repeated rows
    rows += [(None, [1.0] * 4), (300, None), (310, [1.0, None, 1.0, 1.0]), (320, [float("nan")] * 4)]
    rows += [(330, [float("inf")] * 4), (340, []), (350, []), (360, [1.0, 2.0])]
    return rows


def test_against_all_pairs(spark):
    assert _search(_frame(spark, _rows())) == _expected(_rows())


def test_blocks_tiles_and_tree(spark, monkeypatch):
    monkeypatch.setattr(topk, "FAN", 2)
    found = _search(_frame(spark, _rows(), parts=9), block=3, tile=7)
    assert found == _expected(_rows())


def test_large_components(spark):
    rows = [(i, [3e15 * (i - 20), 1.0, -2e18 / (i + 1), 1e30]) for i in range(40)]
    rows += [(50 + i, [float(i) * 1e9, 2.0, -1e9, 5.0]) for i in range(10)]
    found = [r[:3] for r in _search(_frame(spark, rows[40:]))]
    assert found == [r[:3] for r in _expected(rows[40:])]
    assert len(_search(_frame(spark, rows))) == len(_expected(rows))


def test_products_are_exact():
    rng = np.random.default_rng(0)
    for top in (100, 2**40, 2**62):
        a, b = rng.integers(-top, top, (3, 5)), rng.integers(-top, top, (4, 5))
        wanted = [[max(-(2**63), min(2**63 - 1, sum(int(x) * int(y) for x, y in zip(p, q)))) for q in b] for p in a]
        assert topk.products(a, b).tolist() == wanted


def test_empty(spark):
    frame = _frame(spark, [(1, [1.0])])
    assert _search(frame) == [] and _search(frame.where("false")) == []
    assert _search(_frame(spark, [(10, [1.0])])) == []
