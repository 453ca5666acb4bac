"""E8 decoding by its definition, and near-duplicates against brute force."""

import itertools

import numpy as np
import pytest

from stormgauge.llm import lattice


def test_decoded_points_are_the_nearest():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, 8)) * 1.5
    first, second, margin = lattice.nearest_points(x)
    for point in (first, second):
        whole = (point % 2 == 0).all(axis=1)
        half = (point % 2 != 0).all(axis=1)
        assert (whole | half).all()
        assert (point.sum(axis=1) % 4 == 0).all()
    own = ((x - first / 2) ** 2).sum(axis=1)
    # no lattice vector of the shortest kind leads to a nearer point
    steps = [v for v in itertools.product((-1, 0, 1), repeat=8) if sum(map(abs, v)) == 2]
    steps += [np.array(v) / 2 for v in itertools.product((-1, 1), repeat=8) if np.prod(v) > 0]
    for step in steps:
        assert (((x - first / 2 - np.array(step)) ** 2).sum(axis=1) >= own - 1e-9).all()
    assert (margin >= -1e-12).all()


def brute(rows):
    usable = [
        k
        for k, (i, v, label) in enumerate(rows)
        if None not in (i, v, label) and all(x is not None and np.isfinite(x) for x in v) and any(v)
    ]
    root, links = list(range(len(rows))), [0] * len(rows)

    def top(k):
        while root[k] != k:
            k = root[k]
        return k

    for a, b in itertools.combinations(usable, 2):
        (_, x, la), (_, y, lb) = rows[a], rows[b]
        if la != lb or len(x) != len(y):
            continue
        x, y = np.array(x, np.float32).astype(float), np.array(y, np.float32).astype(float)
        if x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= 0.98:
            links[a] += 1
            links[b] += 1
            root[top(a)] = top(b)
    least = {}
    for k, r in enumerate(rows):
        if r[0] is not None:
            least[top(k)] = min(r[0], least.get(top(k), r[0]))
    return [(r[0], links[k], None if r[0] is None else least[top(k)]) for k, r in enumerate(rows)]


def found(spark, rows):
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    out = lattice.near_duplicates(frame).collect()
    assert all(r.kept == (r.vec_id is not None and r.vec_id == r.component_id) for r in out)
    return sorted(((r.vec_id, r.n_links, r.component_id) for r in out), key=str)


@pytest.mark.parametrize("block", [16, 1024])
def test_planted_groups_are_found(spark, monkeypatch, block):
    monkeypatch.setattr(lattice, "BLOCK", block)
    rng = np.random.default_rng(4)
    rows = []
    for g in range(6):
        base = rng.normal(size=64)
        for _ in range(40):
            noisy = base + rng.normal(size=64) * rng.choice([0.0, 0.05, 0.12])
            rows.append((len(rows), noisy.tolist(), g % 2))
    rows += [(len(rows) + i, rng.normal(size=64).tolist(), 0) for i in range(100)]
    got, want = found(spark, rows), sorted(brute(rows), key=str)
    assert [g[1] <= w[1] for g, w in zip(got, want)] == [True] * len(rows)
    assert sum(g[1] for g in got) >= 0.99 * sum(w[1] for w in want)
    assert [(g[0], g[2]) for g in got] == [(w[0], w[2]) for w in want]


def test_bad_rows_and_repeats(spark):
    v = [1.0, 2.0, 3.0, 4.0] * 4
    rows = [(5, v, 1), (5, v, 1), (4, [2 * x for x in v], 1), (3, v, 2), (2, v, None), (1, None, 1)]
    rows += [(0, [0.0] * 16, 1), (9, [float("nan")] * 16, 1), (10, [None, *v[1:]], 1), (11, v[:4], 1)]
    rows += [(None, v, 1), (12, [], 1), (13, [], 1)]
    assert found(spark, rows) == sorted(brute(rows), key=str)
    assert found(spark, []) == []
