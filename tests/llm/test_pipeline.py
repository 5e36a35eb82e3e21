import hashlib

import duckdb
import pytest
import tiktoken
from test_substring_dedup import brute_remove

corpus_pipeline = pytest.importorskip("corpus_pipeline")

from skeinwork.llm import bpe, classifier, queries, simhash  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_stage_by_stage(spark):
    """Every stage against a plain version over its own input."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    first = docs.collect()
    verdict = classifier.classify(docs, spark.read.parquet(f"{SF}/labels.parquet")).filter("kept").collect()
    good = {r.doc_id for r in verdict}
    assert len(good) < len(first)
    rows = {r.doc_id: r.text for r in first if r.doc_id in good}

    prints = {d: simhash.similar_prints(t.encode(), 5) for d, t in rows.items()}

    def linked(x, y):
        bits = [(a ^ b).bit_count() for a, b in zip(x[:-1], y[:-1], strict=True)]
        return bits[0] <= simhash.SIMILAR_RADIUS and sum(bits) <= simhash.SIMILAR_BITS and min(x[-1], y[-1]) >= 0.8 * max(x[-1], y[-1])

    group = {d: d for d in rows}
    for _ in rows:
        best = {d: min(group[e] for e in rows if linked(prints[d], prints[e])) for d in rows}
        if best == group:
            break
        group = best
    rows = {d: t for d, t in rows.items() if group[d] == d}

    rows = {d: new for (d, new, gone) in brute_remove(sorted(rows.items())) if not gone or new.strip(" \t\n\r")}

    con = duckdb.connect()
    con.execute(f"CREATE VIEW benchmark AS SELECT * FROM '{SF}/benchmark.parquet'")
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", list(rows.items()))
    found = con.execute(queries.ORACLES["op1_decontaminate"])
    columns = [c[0] for c in found.description]
    clean = [dict(zip(columns, r, strict=True)) for r in found.fetchall()]
    rows = {r["doc_id"]: rows[r["doc_id"]] for r in clean if not r["contaminated"]}

    path, pattern = queries.tokenizer_file()
    ranks = bpe.BytePairCodec(bpe.read_vocabulary(path), pattern).rank
    encoding = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    want = []
    for d, t in rows.items():
        ids = encoding.encode_ordinary(t)
        want.append((d, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(t.encode()).hexdigest()))
    got = [(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in corpus_pipeline.run(spark, SF).collect()]
    assert sorted(got) == sorted(want)


CLASHES = ["hit", "__key", "__starts", "__score", "key", "row", "raw", "score", "starts", "mark", "c0", "doc", "n_removed", "a.b"]


def clashing(spark):
    texts = [(1, "a b c. " * 9), (2, None), (3, ""), (None, "one of no id"), (None, "another of no id"), (3, "a text of its own"), (7, "x " * 30000)]
    rows = [(d, t, *(["en", "s", len(t)] if t else [None] * 3), *[f"{c}{i}" for c in CLASHES]) for i, (d, t) in enumerate(texts)]
    rows += rows[-1:]
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in CLASHES)
    return spark.createDataFrame(rows, schema)


def test_stages_keep_columns(spark):
    """Nulls, repeated rows, empty and long texts and clashing names through every stage."""
    docs = clashing(spark)
    by_row = {r.hit: r for r in docs.collect()}
    for _, stage in corpus_pipeline.STAGES[:4]:
        out = stage(spark, docs, SF)
        assert out.schema.names == docs.schema.names and out.dtypes == docs.dtypes
        for r in out.collect():
            want = by_row[r.hit]
            assert [r[c] for c in CLASHES] == [want[c] for c in CLASHES] and r.doc_id == want.doc_id
        assert stage(spark, docs.limit(0), SF).collect() == []
    kept = {r.hit for r in simhash.keep_similar(docs).collect()}
    assert len(kept) == 6  # the empty texts are one group
    assert corpus_pipeline.STAGES[4][1](spark, docs, SF).count() == 8


def test_run_over_odd_documents(spark, tmp_path):
    clashing(spark).write.parquet(f"{tmp_path}/documents.parquet")
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{SF}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    rows = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert len({r.decoded_sha256 for r in rows}) == len(rows) > 0
    empty = spark.read.parquet(f"{tmp_path}/documents.parquet").limit(0)
    empty.write.parquet(f"{tmp_path}/none/documents.parquet")
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{SF}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/none/{name}.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").collect() == []
