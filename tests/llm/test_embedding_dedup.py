import math

import numpy as np
import pytest

from skeinwork.llm import embedding_dedup as dedup


def brute(rows, similarity):
    """vec_id, n_links, component_id, kept by comparing all pairs."""

    def unit(v):
        if not v or any(x is None or not math.isfinite(x) for x in v) or not any(v):
            return None
        a = np.array(v) / max(map(abs, v))
        return a / math.sqrt(float((a * a).sum()))

    made = [unit(v) for _, v, _ in rows]
    links = [[] for _ in rows]
    for i, (_, _, label) in enumerate(rows):
        for j in range(i):
            if label is not None and label == rows[j][2] and made[i] is not None and made[j] is not None and len(made[i]) == len(made[j]):
                if float(made[i] @ made[j]) >= similarity:
                    links[i].append(j)
                    links[j].append(i)
    out = [None] * len(rows)
    for i in range(len(rows)):
        if out[i] is None:
            group, todo = {i}, [i]
            while todo:
                for j in links[todo.pop()]:
                    if j not in group:
                        group.add(j)
                        todo.append(j)
            ids = [rows[j][0] for j in group if rows[j][0] is not None]
            for j in group:
                name = min(ids, default=None)
                out[j] = (rows[j][0], len(links[j]), name, rows[j][0] == name)
    return out


def rows_of(seed, n, dim, hot=0):
    rng = np.random.default_rng(seed)
    rows, ids = [], iter(range(10_000))
    for _ in range(n // 6):
        middle = rng.normal(size=dim)
        for _ in range(6):
            scale = 10.0 ** rng.integers(-3, 4)
            # Some pairs of a cluster are just above the limit, some just below.
            near = middle + rng.normal(size=dim) * rng.choice([0.0, 0.05, 0.14, 0.2, 0.5])
            rows.append((next(ids), (near * scale).tolist(), int(rng.integers(0, 2))))
    base = rng.normal(size=dim)
    rows += [(next(ids), base.tolist(), 1) for _ in range(hot)]
    rows += [(next(ids), (base + rng.normal(size=dim) * 0.05).tolist(), 1) for _ in range(hot)]
    one = rows[0]
    rows += [one, (None, one[1], one[2]), (None, [9.0] + [0.0] * (dim - 1), 7), (None, [8.0] + [0.0] * (dim - 1), 7)]
    rows += [(one[0], rows[7][1], rows[7][2]), (next(ids), [1e-310] + [0.0] * (dim - 1), 5), (next(ids), [1.7e308] * dim, 5), (next(ids), [1.6e308] * dim, 5)]
    bad = [None, [], [0.0] * dim, [None] * dim, [math.nan] + [1.0] * (dim - 1), [math.inf] * dim, [1.0, 2.0], [2.0, 4.0], [1.0, 2.0, 2.0]]
    rows += [(next(ids), v, 1) for v in bad]
    return rows + [(next(ids), one[1], None), (next(ids), one[1], None)]


def frame(spark, rows, parts=5):
    return spark.createDataFrame([(*r, 1, "x", 2, 3) for r in rows], "vec_id long, embedding array<double>, label int, node int, x string, n int, cell int").repartition(parts)


def order(rows):
    return sorted((tuple(r) for r in rows), key=repr)


@pytest.mark.parametrize(("seed", "n", "dim", "hot", "cell", "tile"), [(1, 240, 8, 0, 10, 8), (2, 180, 16, 60, 1024, 16), (3, 240, 4, 30, 6, 1024), (4, 120, 3, 0, 4, 4)])
def test_equals_all_pairs(spark, seed, n, dim, hot, cell, tile):
    rows = rows_of(seed, n, dim, hot)
    found = dedup.near_duplicate_vectors(frame(spark, rows), cell=cell, tile=tile)
    assert found.columns == ["vec_id", "n_links", "component_id", "kept"]
    expected = brute(rows, 0.98)
    assert any(not r[3] for r in expected)
    assert order(found.collect()) == order(expected)


def test_empty_and_unlinkable(spark):
    rows = rows_of(5, 12, 4)
    assert dedup.near_duplicate_vectors(frame(spark, rows).filter("vec_id < 0")).collect() == []
    assert order(dedup.near_duplicate_vectors(frame(spark, rows).filter("label is null")).collect()) == order(brute(rows[-2:], 0.98))


def test_cells_lose_no_link():
    """However badly the centroids are placed, every linked pair meets in one cell."""
    rng = np.random.default_rng(3)
    for dim, cells in ((3, 20), (8, 40), (32, 60)):
        middles = rng.normal(size=(60, dim))
        unit = dedup.units(np.concatenate([middles + rng.normal(size=middles.shape) * s for s in (0, 0.03, 0.1, 0.15, 0.2)]))
        for means in (dedup.spherical_means(unit, cells), dedup.units(rng.normal(size=(cells, dim))), unit[[0] * 3 + [1] * 2]):
            rows, cells = dedup.cells_of(unit, means, 0.98)
            places = [set() for _ in unit]
            for i, c in zip(rows.tolist(), cells.tolist(), strict=True):
                places[i].add(c)
            assert all((unit @ means.T).argmax(axis=1)[i] in p for i, p in enumerate(places))
            a, b = np.nonzero(np.triu(unit @ unit.T >= 0.98, 1))
            assert len(a)
            assert all(places[i] & places[j] for i, j in zip(a.tolist(), b.tolist(), strict=True))


def test_means_of_opposite_and_equal_vectors():
    sample = dedup.units(np.array([[1.0, 0.0], [-1.0, 0.0], [1.0, 0.0], [0.0, 1.0]]))
    means = dedup.spherical_means(sample, 3)
    assert np.allclose(np.linalg.norm(means, axis=1), 1.0)
    assert means.shape == (3, 2)
