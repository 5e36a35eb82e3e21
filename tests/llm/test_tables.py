from threading import Thread

from pyspark.sql import functions as F

from skeinwork.llm import simhash, substring_dedup
from skeinwork.llm.common import Tables, cut


def test_tables_belong_to_their_block(spark):
    with Tables() as outer:
        kept = cut(spark.range(3).toDF("a"), "kept")
        with Tables() as inner:
            left, gone = cut(spark.range(4).toDF("a"), "left"), cut(spark.range(5).toDF("a"), "gone")
            inner.drop(spark, keep="left")
        assert len(outer.paths) == 2
        assert (kept.count(), left.count()) == (3, 4)
        assert [p.rsplit("/", 1)[1].split("-")[0] for p in outer.paths] == ["kept", "left"]
    assert gone.inputFiles()  # listed when it was read first, gone since
    outer.drop(spark)
    assert outer.paths == []


def test_operators_side_by_side(spark):
    """Each removes what it wrote itself, in whatever thread of the session it runs."""
    texts = [f"the passage number {i % 7} " + "is said again and again " * 20 for i in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    counts, errors = {}, []

    def run(name, make):
        try:
            counts[name] = make().agg(F.count(F.lit(1))).first()[0]
        except Exception as e:  # the thread would swallow it
            errors.append((name, e))

    jobs = {
        "spans": lambda: substring_dedup.remove_repeated_spans(docs),
        "groups": lambda: simhash.near_duplicate_groups(docs),
        "more": lambda: simhash.near_duplicate_groups(docs.filter("doc_id < 50")),
        "again": lambda: substring_dedup.remove_repeated_spans(docs.filter("doc_id < 40")),
    }
    threads = [Thread(target=run, args=job) for job in jobs.items()]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert errors == []
    assert counts == {"spans": 60, "groups": 60, "more": 50, "again": 40}
