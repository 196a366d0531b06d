import math

import numpy as np
import pytest

from orbita.llm import hard_negatives as H

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows):
    best = {}
    for i, v, label in rows:
        if i is None or v is None or label is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        row = (label, [math.floor(256 * float(np.float32(x))) for x in v])
        best[i] = min(best.get(i, row), row)
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    out = []
    for a in sorted(k for k in best if k % 50 == 0):
        label, v = best[a]
        scored = [(-dot(v, w), i, m) for i, (m, w) in best.items() if i != a]
        near = sorted((s, i) for s, i, m in scored if m == label)[:5]
        for s, i in near:
            inside = sorted((t, j) for t, j, m in scored if m != label and 50 * -s <= 100 * -t <= 95 * -s)[:3]
            out += [(a, i, k, j, -s, -t) for k, (t, j) in enumerate(inside, 1)]
    return sorted(out)


def got(df):
    assert df.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(map(tuple, df.collect()))


def vectors(n, dims, seed, labels=3, ties=False):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dims)) + rng.normal(size=(labels, dims))[rng.integers(0, labels, n)]
    if ties:
        x = np.round(x)
    return [(int(i), [float(np.float32(c)) for c in x[k]], int(rng.integers(0, labels))) for k, i in enumerate(rng.permutation(2 * n)[:n])]


@pytest.mark.parametrize("n,dims,seed,ties", [(300, 12, 1, False), (400, 3, 2, True), (150, 33, 3, False)])
def test_equals_brute_force(spark, n, dims, seed, ties):
    rows = vectors(n, dims, seed, ties=ties)
    assert got(H.mine(spark.createDataFrame(rows, SCHEMA))) == brute(rows)


def test_grid_of_many_cells(spark, monkeypatch):
    monkeypatch.setattr(H, "ROWS", 40)
    monkeypatch.setattr(H, "ANCHORS", 2)
    monkeypatch.setattr(H, "ROUND_GROUPS", 2)
    rows = vectors(300, 8, 5)
    assert got(H.mine(spark.createDataFrame(rows, SCHEMA))) == brute(rows)


def test_odd_rows(spark):
    v = [1.0, 0.5]
    rows = [(0, v, 1), (1, v, 1), (1, v, 1), (2, [1.0, 0.4], 2), (2, [1.0, 0.4], 2), (3, [0.9], 2), (4, [float("nan"), 1.0], 2),
            (5, [float("inf"), 1.0], 1), (6, [None, 1.0], 2), (7, None, 2), (8, [1.0, 0.45], None), (None, [1.0, 0.45], 2), (9, [], 2),
            (50, [-1.0, 0.0], 7), (100, [0.0, 0.0], 1), (150, v, 2), (150, [0.2, 0.2], 2)]
    table = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' as g", "'y' as r", "'z' as label2")
    assert got(H.mine(table)) == brute(rows)
    assert H.mine(spark.createDataFrame([], SCHEMA)).count() == 0
    assert H.mine(spark.createDataFrame([(1, v, 1)], SCHEMA)).count() == 0


def test_large_components_stay_exact(spark):
    rows = [(i, [float(2**20 + i), float(-(2**19) + 3 * i)], i % 2) for i in (0, 1, 2, 3, 4, 5, 50, 51)]
    assert got(H.mine(spark.createDataFrame(rows, SCHEMA))) == brute(rows)
    with pytest.raises(ValueError, match="64 bits"):
        H.mine(spark.createDataFrame([(0, [1e30], 1), (1, [1e30], 1)], SCHEMA))


def test_bounds_prune_and_lose_nothing():
    rng = np.random.default_rng(4)
    x = np.floor(256 * (rng.normal(size=(500, 24)) * np.geomspace(3, 0.05, 24))).T.copy()
    low, high, anchor, read = x.min(axis=1), x.max(axis=1), x[:, 7], []

    def keep(lower, upper):
        read.append(len(lower))
        return upper >= H.kth_largest(lower, 5) if len(lower) > 5 else np.ones(len(lower), bool)

    found, score = H.bond_scan(x, low, high, anchor, np.arange(500), keep)
    want = np.argsort(-(anchor @ x), kind="stable")[:5]
    assert set(want) <= set(found.tolist()) and read[-1] < read[0]
    assert np.array_equal(score, anchor @ x[:, found])
