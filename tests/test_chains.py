import random

import pytest

from skeinwork.operators import graph


def test_chains_of_a_long_session(spark):
    n = 100_000
    edges = spark.range(1, n).selectExpr("id AS src", "id - 1 AS dst")
    found = graph.chains(edges)
    row = found.selectExpr("count(*)", "sum(steps)", "max(steps)", "max(end)", "max(least)", "sum(CAST(steps = start AS int))").first()
    assert row == (n - 1, n * (n - 1) // 2, n - 1, 0, 0, n - 1)


def test_chains_of_a_forest(spark):
    rng = random.Random(2)
    names = list(range(300))
    rng.shuffle(names)
    up = {names[i]: names[rng.randrange(i)] for i in range(1, 300) if rng.random() < 0.9}

    def walk(x):
        steps, least = 0, x
        start = x
        while x in up:
            x, steps = up[x], steps + 1
            least = min(least, x)
        return start, x, steps, least

    edges = spark.createDataFrame([*up.items(), *list(up.items())[:20], (None, 3), (999, None)], "src long, dst long")
    assert sorted(tuple(r) for r in graph.chains(edges).collect()) == sorted(walk(x) for x in up)
    assert graph.chains(edges.filter("src < 0")).collect() == []
    with pytest.raises(ValueError, match="more than one"):
        graph.chains(spark.createDataFrame([(1, 2), (1, 3)], "src long, dst long"))
    with pytest.raises(ValueError, match="cycle"):
        graph.chains(spark.createDataFrame([(1, 2), (2, 3), (3, 1), (7, 8)], "src long, dst long"))


def test_follows_by_ranges(spark):
    rows = [(i, i % 4 if i % 5 else 0, (i * 37) % 50) for i in range(200)] + [(500, None, 3), (501, None, 3)]
    contexts = spark.createDataFrame(rows, "id long, session_id long, timestamp long").repartition(6)
    whole = graph.follows(contexts)
    assert sorted(tuple(r) for r in graph.follows_by_ranges(contexts).collect()) == sorted(tuple(r) for r in whole.collect())
