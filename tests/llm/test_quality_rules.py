import random
import re

from pyspark.sql import functions as F

from skeinwork.llm import quality_rules as qr

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    ws = WORDS.findall(text)
    seen, repeated = set(), 0
    for line in text.split("\n"):
        if WORDS.search(line):
            repeated += line in seen
            seen.add(line)
    places = {}
    for i in range(len(ws) - 7):
        places.setdefault(tuple(ws[i : i + 8]), []).append(i)
    hit = {j for at in places.values() if len(at) > 1 for i in at for j in range(i, i + 8)}
    failed = len(ws) < 20 or 100 * len(hit) > 30 * len(ws)
    return len(ws), sum(map(len, ws)), len(re.findall(r"[#*$%&|<>]", text)), repeated, len(hit), failed


def make():
    rng = random.Random(6)
    word = lambda: rng.choice(["the", "of", "and", "to", "water", "house", "Green", "évé", "it.", "in", "was", "stone,"])
    prose = lambda n: " ".join(word() + ("\n" if rng.random() < 0.1 else "") for _ in range(n))
    docs = [(i, prose(rng.randrange(15, 400)), "en") for i in range(80)]
    docs += [(100 + i, " ".join(f"{word()}{rng.choice('#*$%')}{rng.choice('|<>&')}{rng.choice('#*')}!!" for _ in range(150)), "en") for i in range(3)]
    docs += [(200, None, "en"), (201, "", None), (202, " \n\t\n", "xx"), (203, "a b c d e f g h " * 40, "en"), (204, prose(200), None), (205, prose(200), "xx"), (None, prose(60), "en"), (5, docs[5][1], "en"), (206, "y" * 100000, "en")]
    return docs


def test_base_counts_match_brute_force(spark):
    docs = make()
    frame = spark.createDataFrame([(*d, 1, "k") for d in docs], "doc_id long, text string, lang string, n_words int, kept string")
    rows = qr.quality_rules(frame).collect()
    got = sorted((str(r.doc_id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in rows)
    assert got == sorted((str(d), *brute(t)) for d, t, _ in docs)
    kept = {r.doc_id: r.kept for r in rows}
    assert not any(kept[100 + i] for i in range(3))
    assert all(kept[i] or dict((d, brute(t)[5]) for d, t, _ in docs)[i] for i in range(80))
    assert kept[204] and kept[205]
    assert not any(r.kept for r in rows if r.base_failed)
    assert qr.quality_rules(frame.limit(0)).collect() == []


def test_repeated_words_on_random_lists():
    rng = random.Random(8)
    for _ in range(300):
        ws = [rng.choice([b"a", b"b"]) for _ in range(rng.randrange(60))]
        text = b" ".join(ws).decode()
        assert qr.repeated_words(ws) == brute(text)[4]


def test_distance():
    import numpy as np

    p, q = np.array([1.0, 0.0]), np.array([0.0, 1.0])
    assert qr.jensen_shannon(p, p) == 0 and abs(qr.jensen_shannon(p, q) - 1) < 1e-12


def languages(n):
    """So many languages with 25 documents each of words of their own, and one odd document each."""
    rng = random.Random(n)
    docs = []
    for k in range(n):
        frequent = [f"{chr(97 + k % 26)}{chr(97 + k // 26)}{i}" for i in range(12)]
        word = lambda f=frequent: rng.choice(f) if rng.random() < 0.6 else f"w{rng.randrange(10**6)}"
        docs += [(100 * k + i, " ".join(word() for _ in range(150)), f"l{k}") for i in range(25)]
        docs.append((100 * k + 99, " ".join(f"w{rng.randrange(10**6)}" for _ in range(150)), f"l{k}"))
    return docs


def test_common_words_and_every_language(spark, monkeypatch):
    monkeypatch.setattr(qr, "WIDESPREAD", 3)
    docs = languages(30)
    frame = spark.createDataFrame(docs, "doc_id long, text string, lang string").repartition(5)
    common = {r.lang: (r.n_docs, [bytes(w).decode() for w in r.words]) for r in qr.common_words(frame).collect()}
    for k in (0, 7, 29):
        own = [set(t.split()) for _, t, lang in docs if lang == f"l{k}"]
        share = {w: sum(w in x for x in own) for w in set().union(*own)}
        want = sorted((w for w in share if share[w] >= 0.1 * len(own)), key=lambda w: (-share[w], w))[: qr.COMMON_WORDS]
        assert common[f"l{k}"] == (26, want)
    rows = {r.doc_id: r for r in qr.quality_rules(frame).collect()}
    assert all(rows[d].kept == (d % 100 != 99) for d, _, _ in docs)


def test_kept_matches_sql(spark):
    import duckdb

    from skeinwork.llm import oracles

    docs = make() + [(1000 + d, t, lang) for d, t, lang in languages(3)] + [(9000, "слово и " * 90, "l1"), (9001, "ab " * 120 + "你好 \U0001f600 --(x)", None)]
    docs = [(i, t, lang) for i, (_, t, lang) in enumerate(docs)]
    rows = qr.quality_rules(spark.createDataFrame(docs, "doc_id long, text string, lang string")).drop("char_distance", "word_distance").collect()
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?)", docs)
    assert sorted(tuple(r) for r in rows) == sorted(con.execute(oracles.ORACLES["op3_quality_rules"]).fetchall())
    assert 0 < sum(r.kept for r in rows) < len(rows)


def test_without_languages(spark):
    """Character classes are judged by all documents' mean; what is clean with languages stays."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    named = {r.doc_id: r for r in qr.quality_rules(docs).collect()}
    bare = {r.doc_id: r for r in qr.quality_rules(docs.withColumn("lang", F.lit(None).cast("string"))).collect()}
    gone = {d for d, r in bare.items() if not r.base_failed and not r.kept}
    assert gone and all(bare[d].word_distance is None and bare[d].char_distance > qr.CHAR_LIMIT for d in gone)
    assert gone <= {d for d, r in named.items() if not r.kept}
    few = docs.filter("doc_id < 5").withColumn("lang", F.lit(None).cast("string"))
    assert all(r.char_distance is None for r in qr.quality_rules(few).collect())
