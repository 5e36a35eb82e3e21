import random

from skeinwork.llm import simhash


def _words(rng, n):
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(4)) for _ in range(n))


def test_keep_first_of_null_and_shared_ids(spark):
    rng = random.Random(2)
    a, b, c, d, e = (_words(rng, 40) for _ in range(5))
    rows = [(None, a), (None, b), (None, b), (7, c), (7, d), (3, e), (7, e)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = sorted((str(r.doc_id), r.text) for r in simhash.keep_first(docs).collect())
    assert kept == sorted([("None", a), ("None", b), ("7", c), ("7", d), ("3", e)])
