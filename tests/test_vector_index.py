import numpy as np
import pytest

from skeinwork.operators import graph, vector_index


def frame(spark, rows, kind="long"):
    return spark.createDataFrame(rows, f"id {kind}, embedding array<double>").repartition(5)


def clustered(seed, n, dim, groups=12):
    rng = np.random.default_rng(seed)
    middles = rng.normal(size=(groups, dim))
    rows = [(i, (middles[i % groups] + rng.normal(size=dim) * 0.4).tolist()) for i in range(n)]
    rows += [(n + i, (middles[0] * 3).tolist()) for i in range(30)]  # a hot vector
    bad = [None, [0.0] * dim, [1.0] * (dim + 1), [float("nan")] * dim, [None] * dim]
    return rows + [(n + 100 + i, v) for i, v in enumerate(bad)] + [(None, [1.0] * dim)]


def answers(found):
    return sorted((r.query_id, r.rank, round(r.score, 9), r.id) for r in found.collect())


@pytest.mark.parametrize(("seed", "n", "dim", "lists"), [(1, 400, 8, None), (2, 300, 24, 6), (3, 200, 3, 50)])
def test_exact_search_equals_a_scan(spark, tmp_path, seed, n, dim, lists):
    rows = frame(spark, clustered(seed, n, dim))
    path = str(tmp_path / "index")
    vector_index.build_index(rows, path, "e", lists=lists)
    queries = rows.filter("id % 7 = 0 or id >= 500")
    scan = graph.nearest_batch(rows, queries, 5)
    found = vector_index.search_index(spark, path, queries, 5, exact=True)
    # Copies tie; rounding may order them in two ways, their scores are equal.
    assert [a[:3] for a in answers(found)] == [a[:3] for a in answers(scan)]
    near = vector_index.search_index(spark, path, queries, 5)
    measured = vector_index.recall(near, found).first()
    assert measured.n_queries == len({a[0] for a in answers(scan)}) and measured.recall >= 0.9
    listed = vector_index.list_indexes(spark, [path]).first()
    assert (listed.name, listed.dimensions, listed.entries, listed.state) == ("e", dim, n + 30, "ONLINE")
    assert listed.lists == (lists or int(np.ceil(np.sqrt(n + 30)))) and 1 <= listed.probes <= listed.lists


def test_few_folders_are_read(spark, tmp_path):
    rows = frame(spark, clustered(4, 600, 16))
    path = str(tmp_path / "index")
    vector_index.build_index(rows, path, "e", lists=20)
    found = vector_index.search_index(spark, path, rows.filter("id = 3"), 5, probes=2)
    found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan.lower()
    assert {a[3] % 12 for a in answers(found)} == {3}


def test_no_search_broadcasts_queries_by_list_or_candidates(spark, tmp_path):
    """There are as many as queries times lists, which the planner does not foresee; only the lists' numbers are sent."""
    rows = frame(spark, clustered(4, 600, 16))
    path = str(tmp_path / "index")
    vector_index.build_index(rows, path, "e", lists=20)
    for exact in (False, True):
        found = vector_index.search_index(spark, path, rows.filter("id % 3 = 0"), 5, exact=exact)
        found.collect()
        final = found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        joins = {kind: final.count(f"{kind} [list#") for kind in ("SortMergeJoin", "BroadcastHashJoin")}
        assert joins["SortMergeJoin"] == (4 if exact else 2) and joins["BroadcastHashJoin"] == final.count("LeftSemi")
        assert "dynamicpruning" in final.lower()


def test_empty_and_text_ids(spark, tmp_path):
    path = str(tmp_path / "a")
    vector_index.build_index(frame(spark, [(1, [0.0, 0.0])]), path, "e")
    assert vector_index.search_index(spark, path, frame(spark, [(2, [1.0, 0.0])]), exact=True).collect() == []
    assert vector_index.list_indexes(spark, [path]).first().entries == 0
    path = str(tmp_path / "b")
    rows = frame(spark, [("a", [1.0, 0.0]), ("b", [1.0, 0.1]), ("c", [0.0, 1.0])], "string")
    vector_index.build_index(rows, path, "e")
    found = vector_index.search_index(spark, path, rows.filter("id = 'a'"), 2, exact=True)
    assert [(a[1], a[3]) for a in answers(found)] == [(1, "b"), (2, "c")]


def test_codes_bound_their_error():
    rng = np.random.default_rng(1)
    sample = rng.normal(size=(300, 12))
    sample /= np.linalg.norm(sample, axis=1, keepdims=True)
    means, probes = vector_index.fitted(sample, 10, 0.97, 10)
    assert np.allclose(np.linalg.norm(means, axis=1), 1) and 1 <= probes <= 10
    assert vector_index.fitted(sample[:1], 1, 0.9, 10)[1] == 1
