import random
from collections import defaultdict

import numpy as np
import pytest

from edgeframe.llm import minhash


def _sets(rows):
    out = []
    for _, text in rows:
        words = (text or "").encode().lower().split()
        grams = [tuple(words)] if 0 < len(words) < 5 else [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
        out.append(frozenset(grams))
    return out


def _expected(rows, percent=75):
    sets = _sets(rows)
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and sets[j] and 100 * both >= percent * len(a | sets[j]):
                parent[root(i)] = root(j)
    least = defaultdict(list)
    for i, (key, _) in enumerate(rows):
        if key is not None:
            least[root(i)].append(key)
    out = []
    for i, (key, _) in enumerate(rows):
        component = min(least[root(i)], default=None)
        out.append((key, len(sets[i]), component, key == component))
    return sorted(out, key=str)


def _near(words, changes, rng):
    words = list(words)
    for at in rng.sample(range(len(words)), changes):
        words[at] = f"w{rng.random()}"
    return words


@pytest.fixture
def rows(prose, odd):
    rng = random.Random(9)
    found = list(odd)
    for family in range(12):
        base = prose(120, family).split()
        for copy in range(rng.randint(1, 6)):
            found.append((1000 + 10 * family + copy, " ".join(_near(base, rng.randint(0, 3), rng))))
    passage = prose(80, 99)
    found += [(3000 + i, prose(60, 500 + i) + " " + passage) for i in range(20)]
    found += [(4000, "A b\tC d"), (4001, "a B c  d"), (4002, "a b c d e"), (4003, prose(6000, 7))]
    rng.shuffle(found)
    return found


def test_against_all_pairs(frame, rows):
    found = sorted(map(tuple, minhash.report(frame(rows)).collect()), key=str)
    assert found == _expected(rows)


def test_postings_with_several_components_are_compared_in_full(frame, prose):
    # Chains of near copies whose ends are far apart, with the smallest class in the middle.
    rng = random.Random(4)
    found = []
    for chain in range(6):
        words = prose(150, chain).split()
        for step in range(8):
            found.append((chain * 100 + (step * 37) % 8, " ".join(words)))
            words = _near(words, 3, rng)
    got = sorted(map(tuple, minhash.report(frame(found), tile=4).collect()), key=str)
    assert got == _expected(found)


def test_tiles_link_what_all_pairs_link(spark):
    rng = np.random.default_rng(0)
    base = np.unique(rng.integers(0, 2**62, 300, np.uint64))
    sets = []
    for _ in range(60):
        keep = rng.random(len(base)) > rng.choice([0.02, 0.1, 0.3])
        sets.append(np.unique(np.concatenate([base[keep], rng.integers(0, 2**62, 20, np.uint64)])))
    sigs = minhash.signatures(sets, 64)
    common = sigs[:, 5] == np.median(sigs[:, 5])
    schema = "id long, n_shingles long, _mask long, _signature array<int>"
    classes = spark.createDataFrame(
        [(i, len(s), 1 << 5, sigs[i].tolist()) for i, s in enumerate(sets) if common[i]], schema
    )
    members = [i for i in range(60) if common[i]]
    postings = spark.createDataFrame([(i, 5, 77) for i in members], "id long, at int, token long")
    labels = spark.createDataFrame([(i, min(i, i - i % 4)) for i in members[:20]], "id long, label long")
    held = spark.createDataFrame([(i, sets[i].tobytes()) for i in members], "id long, _set binary")
    label = {i: i for i in members} | {i: i - i % 4 for i in members[:20]}

    def parts(links):
        root = dict(label)
        for a, b in links:
            x, y = root[a], root[b]
            root = {k: x if v == y else v for k, v in root.items()}
        return {frozenset(k for k in root if root[k] == r) for r in root.values()}

    wanted = [
        (a, b)
        for a in members
        for b in members
        if a < b and (sigs[a] == sigs[b]).sum() >= 32 and minhash.similar(sets[a].tobytes(), sets[b].tobytes(), 75)
    ]
    for tile in (7, 1000):
        dealt = minhash.tiles(postings, labels, tile)
        links = [tuple(r) for r in minhash.tile_links(dealt, classes, held, 32, 75).collect()]
        assert len(links) < len(members) * (1 + len(members) // tile)
        assert parts(links) == parts(wanted) and len(parts(wanted)) > 1


def test_components_of_paths_and_stars(spark):
    rng = random.Random(1)
    edges, names = [], list(range(300))
    rng.shuffle(names)
    edges += [(names[i], names[i + 1]) for i in range(99)]
    edges += [(names[100], names[i]) for i in range(101, 200)]
    edges += [(names[i], names[i + 1]) for i in range(200, 299, 2)]
    found = dict(minhash.components(spark.createDataFrame(edges, "a long, b long")).collect())
    parts = [names[:100], names[100:200]] + [names[i : i + 2] for i in range(200, 299, 2)]
    assert found == {n: min(p) for p in parts for n in p}


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(3)
    common = rng.integers(0, 2**63, 3000, np.uint64)
    a, b = np.unique(common), np.unique(np.concatenate([common[:2500], rng.integers(0, 2**63, 300, np.uint64)]))
    true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
    sig = minhash.signatures([a, b], 1024)
    assert abs((sig[0] == sig[1]).mean() - true) < 0.05


def test_chance_of_missing_a_pair_at_the_threshold():
    from math import comb

    missed = sum(comb(64, i) * 0.75**i * 0.25 ** (64 - i) for i in range(minhash.MATCHES))
    assert missed < 1e-5


def test_stage_keeps_one_of_each_component(frame, rows):
    kept = minhash.deduplicated(frame(rows))
    assert kept.columns == ["doc_id", "text", "_row", "score", "ids"]
    wanted = sorted([r[0] for r in _expected(rows) if r[0] is None or r[3]], key=str)
    assert sorted((r.doc_id for r in kept.collect()), key=str) == wanted


def test_stage_with_repeated_and_null_keys(frame, prose):
    rng = random.Random(3)

    def near(text):
        return " ".join(_near(text.split(), 1, rng))

    copied, twice, unnamed, named = (prose(120, 900 + i) for i in range(4))
    rows = [
        (1, copied), (5, near(copied)), (5, prose(60, 910)),  # the second 5 is unrelated
        (7, twice), (7, near(twice)),
        (None, unnamed), (None, near(unnamed)), (None, unnamed), (None, prose(60, 911)),
        (9, named), (None, near(named)),
    ]
    groups = [rows[:2], [rows[2]], rows[3:5], rows[5:8], [rows[8]], rows[9:]]
    kept = [(r.doc_id, r.text) for r in minhash.deduplicated(frame(rows)).collect()]
    assert [sum(k in group for k in kept) for group in groups] == [1] * len(groups)
    assert len(kept) == len(groups) and rows[0] in kept and rows[9] in kept


def test_empty_table(frame):
    assert minhash.report(frame([(1, "a")]).where("false")).count() == 0
