import random

import pytest
from pyspark.sql import functions as F

from skeinwork.operators import graph
from skeinwork.plans.stored import ChangedMeanwhileError, Kind, StoredTables

KIND = Kind(("k",), "k long, at long, name string, value string", ("at", "value"), ("name",), ("value",))
PAIRS = Kind(("src", "dst"), "src string, dst string", by=("src",))
SCHEMA = "k long, at long, name string, value string"


def folders(tables, name):
    return tables.snapshot()[1][name]


def test_merged_in_any_order_as_at_once(spark, tmp_path):
    rng = random.Random(4)
    rows = [(rng.randrange(40), at, f"n{at}", f"v{at}") for at in range(300)] + [(None, 1, "n", "v"), (None, 2, "m", "w")]
    want = graph.upsert(spark.createDataFrame(rows, SCHEMA), ["k"], ["at", "value"], ["name"], ["value"])
    want = sorted((r.k or -1, r.name, r.value) for r in want.collect())
    for i, seed in enumerate((1, 2)):
        tables = StoredTables(spark, str(tmp_path / f"t{i}"), {"t": KIND}, 4)
        shuffled = rows[:]
        random.Random(seed).shuffle(shuffled)
        batches = [shuffled[:100], shuffled[100:250], shuffled[250:], shuffled[50:120]]
        for batch in batches:
            tables.merge({"t": spark.createDataFrame(batch, SCHEMA)})
        assert sorted((r.k or -1, r.name, r.value) for r in tables.read("t").collect()) == want


def test_one_key_rewrites_one_bucket(spark, tmp_path):
    tables = StoredTables(spark, str(tmp_path / "t"), {"t": KIND, "p": PAIRS}, 8)
    assert tables.read("t").collect() == []
    tables.merge({"t": spark.range(200).selectExpr("id AS k", "1 AS at", "'a' AS name", "'b' AS value"), "p": spark.createDataFrame([("x", "y"), ("x", "y")], "src string, dst string")})
    before, pairs = folders(tables, "t"), folders(tables, "p")
    assert len(before) == 8 and tables.read("p").count() == 1
    tables.merge({"t": spark.createDataFrame([(17, 2, "later", "changed")], SCHEMA)})
    after = folders(tables, "t")
    assert len({b for b in after if after[b] != before.get(b)}) == 1 and folders(tables, "p") == pairs
    assert tables.read("t").filter("k = 17").select("name", "value").first() == ("a", "changed")
    assert tables.look_up("t", k=17).first().value == "changed"
    assert tables.look_up("t", k=999).collect() == []
    # One bucket's files are all that a look-up reads, and reading groups nothing.
    assert all("bucket=" in f for f in tables.look_up("t", k=17).inputFiles()) and len({f.split("bucket=")[1][0] for f in tables.look_up("t", k=17).inputFiles()}) == 1
    plan = tables.read("t")._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate" not in plan and "Exchange" not in plan
    # An older snapshot stays readable until it is removed.
    assert tables.read("t", 1).filter("value = 'changed'").count() == 0
    gone = tables.vacuum()
    assert len(gone) == 1 and tables.versions() == [2]
    assert tables.read("t").count() == 200


def test_a_second_writer_fails_and_leaves_no_trace(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "t")
    one, other = (StoredTables(spark, root, {"t": KIND}, 2) for _ in range(2))
    one.merge({"t": spark.createDataFrame([(1, 1, "a", "b")], SCHEMA)})
    seen = other.snapshot()
    one.merge({"t": spark.createDataFrame([(2, 1, "a", "b")], SCHEMA)})
    monkeypatch.setattr(other, "snapshot", lambda version=None: seen)
    with pytest.raises(ChangedMeanwhileError):
        other.merge({"t": spark.createDataFrame([(3, 1, "a", "b")], SCHEMA)})
    assert sorted(r.k for r in one.read("t").collect()) == [1, 2]
    monkeypatch.undo()
    other.merge({"t": spark.createDataFrame([(3, 1, "a", "b")], SCHEMA)})
    assert sorted(r.k for r in one.read("t").collect()) == [1, 2, 3]
    assert one.merge({"t": spark.createDataFrame([], SCHEMA)}) == 4
    assert one.read("t").select(F.sum("k")).first()[0] == 6
