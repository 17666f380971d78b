import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from edgeframe.llm import trie

FIELDS = "conv_id long, turn long, role string, text string, depth int, _n string, _shard double"


@pytest.fixture
def conversations(spark):
    def make(rows, parts=3):
        wide = [(*r, 1, "x", 0.5) for r in rows]
        return spark.createDataFrame(wide, FIELDS).repartition(parts)

    return make


def _expected(rows, rebuilt):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            said = (role or "", text or "")
            digest = hashlib.md5(f"{len(said[0])}:{said[0]}{said[1]}".encode()).hexdigest()
            own[conv].append((turn is not None, turn, digest, said))
    own = {c: [t[-1] for t in sorted(turns, key=lambda t: t[:3])] for c, turns in own.items()}
    paths = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6 if rebuilt else 0
        paths[c] = own.get(c - c % 100, [])[:h] + turns[h:] if rebuilt else turns
    members = defaultdict(set)
    for c, path in paths.items():
        for d in range(len(path) + 1):
            members[tuple(path[:d])].add(c)
    found = set()
    kids = defaultdict(list)
    for node in members:
        if node:
            kids[node[:-1]].append(node)

    sums = {}
    for node in sorted(members, key=len, reverse=True):
        own_part = (len(members[node]) - 1) * len(node[-1][1]) if node else 0
        leaves = 0 if kids[node] else 1
        sums[node] = (leaves + sum(sums[k][0] for k in kids[node]), own_part + sum(sums[k][1] for k in kids[node]))
    for node, inside in members.items():
        ends = ",".join(map(str, sorted(c for c in inside if len(paths[c]) == len(node))))
        found.add((min(inside), len(node), min(members[node[:-1]]) if node else None, len(inside), len(kids[node]),
                   *sums[node], hashlib.sha256(ends.encode()).hexdigest()))
    return found


def _rows(seed, convs, most, words=2):
    rng = random.Random(seed)
    rows = []
    for c in convs:
        for t in range(rng.randint(0, most)):
            rows.append((c, t, rng.choice(["user", "assistant"][t % 2:][:1]), rng.choice(["hi", "é you", "", "ok then"][:words])))
    return rows


def _check(frame, rows, **options):
    found = [tuple(r) for r in trie.nodes(frame, **options).collect()]
    want = _expected(rows, options.get("rebuilt", False))
    assert len(found) == len(want) and set(found) == want


def test_rebuilt_conversations(conversations, monkeypatch):
    monkeypatch.setattr(trie, "ROWS", 64)  # many shards
    rows = _rows(1, [*range(0, 260), 405, 999, 1000, 12345], 9, 3)
    rows += [(70, None, None, None), (70, None, "user", None), (None, 1, "user", "lost"), (71, 2, "user", "x")]
    rows += [(71, 2, "user", "x")] * 2  # repeated rows are turns
    _check(conversations(rows), rows, rebuilt=True)


def test_long_conversations_are_cut_into_segments(conversations, monkeypatch):
    monkeypatch.setattr(trie, "ROWS", 32)
    rows = _rows(2, range(12), 40, 1)
    rows += [(c, t, "user", "same") for c in (20, 21, 22) for t in range(61)]
    rows += [(23, t, "user", "same" if t < 47 else "other") for t in range(90)]
    _check(conversations(rows), rows, span=8)
    _check(conversations(rows), rows, span=8, rebuilt=True)
    _check(conversations(rows, 5), rows, span=64)


def test_groups_of_copies(conversations, monkeypatch):
    monkeypatch.setattr(trie, "ROWS", 128)
    rows = [(c, t, "user", f"turn {t}") for c in range(300) for t in range(4)] + _rows(5, range(300, 340), 6)
    _check(conversations(rows), rows)


def test_odd_tables(conversations):
    assert trie.nodes(conversations([(1, 1, "a", "b")]).where("false")).count() == 0
    assert trie.nodes(conversations([(None, 1, "a", "b")]), rebuilt=True).count() == 0
    rows = [(7, 0, "user", "long text " * 100_000), (-5, 1, "user", ""), (105, 0, None, "z")]
    found = trie.nodes(conversations(rows), rebuilt=False).collect()
    assert {tuple(r) for r in found} == _expected(rows, False)


def test_walk_is_depth_first():
    import numpy as np

    convs = np.array([1, 1, 2, 2, 3])
    levels = np.array([0, 1, 0, 1, 0])
    hashes = np.array([9, 4, 9, 5, 9])
    out = trie.Shard(convs, levels, hashes, hashes, np.array([0, 3, 0, 2, 0]), np.array([False, True, False, True, True])).walk()
    assert out["up"] == [-1, 0, 0] and out["n"] == [3, 1, 1] and out["enders"] == [0b100, 0b001, 0b010]
    assert out["k1"] == [9, 13, 12] and trie._sizes(out["up"]) == [3, 1, 1]
