import datetime
import json

from skeinwork.operators import graph
from skeinwork.plans import config
from skeinwork.plans.context_store import INPUT, ContextStore


def test_store_and_read(spark, tmp_path):
    clock = iter(datetime.datetime(2024, 1, d) for d in range(1, 9))
    encode = lambda ts: [[1.0, 0.0] if "graph" in t else [0.0, 1.0] for t in ts]
    store = ContextStore(spark, str(tmp_path / "s"), encode, lambda: next(clock))
    assert json.loads(store.list_topics()) == []
    store.init_schema()
    first = json.loads(store.store_context("graph work", "graph graph nodes in src/graph.py def walk(", "S1"))
    second = json.loads(store.store_context("other", "training training model; see src/graph.py", "S1", "P"))
    assert first["topics_extracted"][0] == "graph" and first["code_refs_found"] == ["src/graph.py", "walk"]
    assert second["token_count"] == 5
    hits = json.loads(store.search_contexts("a graph question"))
    assert [h["context_id"] for h in hits] == [first["context_id"]] and "graph" in hits[0]["topics"]
    assert len(json.loads(store.get_file_history("src/graph.py"))) == 2
    assert [h["id"] for h in json.loads(store.get_session_history("S1"))] == [first["context_id"], second["context_id"]]
    assert [h["id"] for h in json.loads(store.get_topic_contexts("training"))] == [second["context_id"]]
    assert {t["name"]: t["context_count"] for t in json.loads(store.list_topics())}["graph"] == 2
    assert store.execute("SELECT count(*) n FROM store_follows").first().n == 1
    assert all(v.count() == 0 for v in store.violations().values())
    assert store.indexes().count() == 0
    store.build_indexes()
    assert store.indexes().select("name", "dimensions", "entries", "state").first() == ("context_embedding", 2, 2, "ONLINE")
    assert [r.id for r in store.nearest("a graph question", 1).collect()] == [first["context_id"]]
    # A context between the two changes who follows whom; the index is older than it.
    third = json.loads(store.store_context("late", "late words", "S1"))
    assert [r.dst for r in store.execute("SELECT dst FROM store_follows WHERE src = :id", id=third["context_id"]).collect()] == [second["context_id"]]
    assert store.indexes().first().state == "STALE"


def test_batches_out_of_order_link_as_at_once(spark, tmp_path):
    rows = [(str(i), "s", "see src/a.py", f"S{i % 3}", "p" if i < 15 else "q", datetime.datetime(2024, 1, 1, i % 24), [1.0], ["t", f"t{i % 4}"]) for i in range(30)]
    whole = graph.ingest(spark.createDataFrame(rows, INPUT))
    store = ContextStore(spark, str(tmp_path / "s"), lambda ts: [[1.0]] * len(ts), lambda: None)
    for part in (rows[20:], rows[:10], rows[5:25], rows[20:]):
        store.store_batch(spark.createDataFrame(part, INPUT))
    for name, made in store.tables().items():
        assert sorted(map(str, made.select(*whole[name].columns).collect())) == sorted(map(str, whole[name].select(*whole[name].columns).collect())), name


def test_config():
    good = {s: {} for s in config.SECTIONS} | {"model": {"name": "m"}, "distillation": {"quality_threshold": 7.0}}
    assert config.problems(good) == []
    bad = good | {"distillation": {"quality_threshold": 11}}
    bad.pop("aws")
    assert len(config.problems(bad)) == 2
