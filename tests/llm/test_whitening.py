import numpy as np
import pytest

from edgeframe.llm import whitening

FIELDS = "vec_id long, embedding array<float>, _vector int, n string, component string"


@pytest.fixture
def vectors(spark):
    def make(rows, parts=3):
        return spark.createDataFrame([(i, v, 1, "x", None) for i, v in rows], FIELDS).repartition(parts)

    return make


def _expected(rows, most=4):
    usable = [(i, np.array(v, np.float32).astype(float)) for i, v in rows if v is not None and None not in v]
    usable = [(i, np.floor(256 * v).astype(np.int64)) for i, v in usable if np.isfinite(v).all()]
    fit = np.array(sorted({tuple(v.tolist()) for _, v in usable}), np.int64)
    n, sums = len(fit), fit.sum(0)
    mean = fit - fit.mean(0)
    covariance = mean.T @ mean / n
    values, axes = np.linalg.eigh(covariance)
    values, axes = values[::-1][:most], axes[:, ::-1][:, :most]
    white = {k: ((v - sums / n) @ axes) / np.sqrt(values) for k, (_, v) in enumerate(usable)}
    deviation = {k: int(((n * v.astype(object) - sums.astype(object)) ** 2).sum()) for k, (_, v) in enumerate(usable)}
    return usable, n, values / np.trace(covariance), white, deviation


def test_against_numpy(vectors):
    rng = np.random.default_rng(4)
    data = rng.normal(0, [1.5, 1, 0.7, 0.4, 0.2, 0.1], (700, 6)).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(data)]
    rows += [(2000 + i, data[5].tolist()) for i in range(300)]  # copies count once in the fit
    rows += [(9001, None), (9002, [1.0, None, 2.0, 0.0, 0.0, 0.0]), (9003, [float("nan")] + [0.0] * 5), (9004, [float("inf")] + [1.0] * 5)]
    found = whitening.whitened(vectors(rows)).collect()
    usable, n, explained, white, deviation = _expected(rows)
    assert len(found) == 4 * len(usable) and {r.n for r in found} == {n}
    by_key = {(r.vec_id, r.component): r for r in found}
    got = np.array([[by_key[i, c].whitened for c in (1, 2, 3, 4)] for i, _ in usable])
    want = np.array([white[k] for k in range(len(usable))])
    signs = np.sign((got * want).sum(0))
    assert np.allclose(got * signs, want, atol=1e-9)
    assert all(by_key[i, 1].deviation == deviation[k] for k, (i, _) in enumerate(usable))
    assert np.allclose([by_key[0, c].explained for c in (1, 2, 3, 4)], explained, rtol=1e-12)
    assert len({r.identity_error for r in found}) == 1 and found[0].identity_error < 1e-9


@pytest.mark.parametrize("rows", [1, 63, 64, 65, 300])
def test_planes_give_exact_products(rows):
    rng = np.random.default_rng(rows)
    values = rng.integers(-1000, 1000, (rows, 5))
    with_ones = np.hstack([values, np.ones((rows, 1), np.int64)])
    assert (whitening.scatter(values) == with_ones.T @ with_ones).all()
    extreme = rng.choice([-(1 << 63), -1, 0, (1 << 63) - 1], (rows, 3)).astype(np.int64)
    wide = np.hstack([extreme.astype(object), np.ones((rows, 1), object)])
    assert (whitening.scatter(extreme) == wide.T.dot(wide)).all()


def test_long_numbers_travel_in_parts():
    total = np.array([[-(1 << 126), (1 << 100) + 5], [0, -1]], object)
    back = {}
    for i, j, limb, part in whitening._limbs(total):
        back[i, j] = back.get((i, j), 0) + (part << (40 * limb))
    assert back == {(0, 0): -(1 << 126), (0, 1): (1 << 100) + 5, (1, 1): -1}


def test_odd_tables(vectors):
    assert whitening.whitened(vectors([(1, [1.0, 2.0])]).where("false")).count() == 0
    assert whitening.whitened(vectors([(1, [1.0, 2.0]), (2, [1.0, 2.0])])).count() == 0  # no variance
    assert whitening.whitened(vectors([(1, []), (2, None)])).count() == 0
    # One dimension varies: one component; null keys and repeated rows keep their rows.
    rows = [(None, [1.0, 5.0]), (2, [3.0, 5.0]), (2, [3.0, 5.0])]
    found = whitening.whitened(vectors(rows)).collect()
    assert len(found) == 3 and {r.component for r in found} == {1} and {r.n for r in found} == {2}
    assert sorted(abs(r.whitened) for r in found) == pytest.approx([1, 1, 1])
    # Another length is another fit.
    mixed = rows + [(7, [1.0]), (8, [2.0]), (9, [4.0])]
    assert sorted(r.n for r in whitening.whitened(vectors(mixed)).collect()) == [2, 2, 2, 3, 3, 3]


def test_huge_components_stop_at_the_limits(vectors):
    found = whitening.whitened(vectors([(1, [3e38, 0.0]), (2, [-3e38, 1.0]), (3, [0.0, 2.0])])).collect()
    assert {r.deviation for r in found if r.vec_id == 1} == {(1 << 63) - 1}
    assert all(np.isfinite(r.whitened) for r in found)
