import hashlib
import math
import random

import numpy as np
import pytest

from skeinwork.llm import centroids
from skeinwork.llm.centroids import EXACT_FLOAT, EXACT_LONG


def brute(rows, k, rounds, dim):
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid) in plain integers."""
    kept = [(i, [math.floor(64 * x) if abs(x) < 2**60 else int(x) * 64 for x in v]) for i, v in rows if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)]

    def name(i):
        return (i is None, "" if i is None else hashlib.sha256(f"1:{i}".encode()).hexdigest())

    means = [v for _, v in sorted(kept, key=lambda p: (name(p[0]), p[1]))[:k]]

    def nearest(v):
        far = [sum((a - b) ** 2 for a, b in zip(v, m)) for m in means]
        return far.index(min(far)), min(far)

    for _ in range(rounds):
        own = [nearest(v)[0] for _, v in kept]
        for c in range(len(means)):
            mine = [v for (_, v), o in zip(kept, own) if o == c]
            if mine:
                means[c] = [sum(x) // len(mine) for x in zip(*mine)]
    found = [(i, *nearest(v)) for i, v in kept]
    cap = lambda x: x if x < EXACT_LONG else None
    total = sum(f[2] for f in found)
    by = {c: sum(f[2] for f in found if f[1] == c) for c in range(len(means))}
    return [(i, c, cap(d), cap(by[c]), cap(total), [str(x) for x in means[c]]) for i, c, d in found]


def rows_of(seed, n, dim, spread=1.0):
    rng = random.Random(seed)
    rows = [(i, [rng.gauss(0, 0.4) * spread + (i % 3) for _ in range(dim)]) for i in range(n)]
    rows += [(n + i, [0.25] * dim) for i in range(n // 3)]  # a hot vector, and ties
    rows += [(0, [0.5] * dim), (0, [0.5] * dim), (None, [1.0] * dim), (None, [-2.5] * dim)]
    bad = [None, [], [0.1] * (dim - 1), [0.1] * (dim + 1), [None] + [0.1] * (dim - 1), [math.nan] * dim, [math.inf] + [0.0] * (dim - 1), [-math.inf] * dim]
    return rows + [(1000 + i, v) for i, v in enumerate(bad)]


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, "c", 3) for i, v in rows], "vec_id long, embedding array<double>, cluster int, x string, distance int").repartition(5)


def order(rows):
    return sorted((tuple(r) for r in rows), key=repr)


@pytest.mark.parametrize(("seed", "n", "k", "spread"), [(1, 90, 16, 1.0), (2, 40, 5, 1e9), (3, 30, 4, 1e22), (4, 60, 3, 1e15)])
def test_equals_plain_integers(spark, seed, n, k, spread):
    rows = rows_of(seed, n, 6, spread)
    found = centroids.cluster(frame(spark, rows), clusters=k, dim=6)
    assert found.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid"]
    assert order(found.collect()) == order(brute(rows, k, 3, 6))


def test_fewer_vectors_than_clusters_and_none(spark):
    rows = [(5, [0.1, -0.1]), (6, [3.0, 4.0]), (7, None)]
    assert order(centroids.cluster(frame(spark, rows), dim=2).collect()) == order(brute(rows, 16, 3, 2))
    assert centroids.cluster(frame(spark, rows[2:]), dim=2).collect() == []
    assert centroids.cluster(frame(spark, rows).filter("vec_id < 0"), dim=2).collect() == []


def test_blocks_at_the_bounds():
    """The three ways of a block agree with plain integers on both sides of each bound."""
    rng = np.random.default_rng(7)
    for power in (20, 24, 25, 26, 27, 28, 29, 30, 31, 33, 60):
        x = rng.integers(-(2**power), 2**power, size=(40, 8)).astype(np.float64) if power < 50 else np.array([[int(rng.integers(1, 9)) * 2**power for _ in range(8)] for _ in range(40)], dtype=object)
        means = [[int(v) for v in row] for row in x[:5].tolist()]
        plain = [[sum((int(a) - b) ** 2 for a, b in zip(row, m)) for m in means] for row in x.tolist()]
        found = centroids.distances(x, means)
        assert [[int(v) for v in row] for row in found.tolist()] == plain
        bound = 8 * (centroids.magnitude(x) + max(abs(v) for m in means for v in m)) ** 2
        assert (found.dtype == object) == (bound >= EXACT_LONG)
        own = found.argmin(axis=1)
        sums = centroids.sums_by(x, own, 6)
        assert sums == [[sum(int(row[j]) for row, o in zip(x.tolist(), own) if o == c) for j in range(8)] for c in range(6)]
    assert 8 * (2**21) ** 2 < EXACT_FLOAT < 8 * (2**26) ** 2


def test_integers_of_large_and_negative_components():
    x = np.array([[-0.001, 0.999, 2.0**52 + 1, -(2.0**60), 1.7e308, 3.5]])
    assert [int(v) for v in centroids.integers(x)[0]] == [-1, 63, (2**52 + 1) * 64, -(2**66), int(1.7e308) * 64, 224]
