import random
import re

import pytest

from skeinwork.llm import license_scan as ls

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def base(text):
    ws = words(text)
    found = []
    for phrase, label in ls.PHRASES:
        p = phrase.split()
        found += [(i, label) for i in range(len(ws) - len(p) + 1) if ws[i : i + len(p)] == p]
    at = [i for i, _ in found]
    return len(ws), len(found), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in found}))


def make():
    rng = random.Random(5)
    texts = ["Under the MIT license", "cc-by/NC", "cc by nc cc by nc 4", "Apache License, Version 2.0!", "the mit", "Kby nc", "éunder the mit license", "foo", "bar,", "\n"]
    docs = [(i, " ".join(rng.choice(texts) for _ in range(rng.randrange(9)))) for i in range(150)]
    gpl = next(body for label, body in ls.TEMPLATES if label == "gpl-3")
    edited = gpl.replace("redistribute it", "freely redistribute it").replace("published by", "was published once by")
    docs += [(500, None), (501, ""), (502, "..."), (503, "Some text. " + edited.upper() + " More."), (504, gpl[: len(gpl) // 4]), (None, "cc by nc"), (3, docs[3][1]), (3, docs[3][1]), (505, "by " * 30000 + "nc")]
    return docs


def test_base_matches_brute_force_and_method_adds(spark):
    docs = make()
    frame = spark.createDataFrame([(d, t, 1, "a") for d, t in docs], "doc_id long, text string, rid int, label string")
    templates = spark.createDataFrame(ls.TEMPLATES, "label string, body string")
    rows = ls.license_scan(frame, templates).collect()
    got = sorted(map(str, [(str(r.doc_id), r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in rows]))
    assert got == sorted(map(str, [(str(d), *base(t)) for d, t in docs]))
    by_id = {r.doc_id: r for r in rows}
    assert by_id[503].labels == "gpl-3" and by_id[503].base_labels == "" and 0.6 <= by_id[503].score <= 1
    assert by_id[504].labels == "" and by_id[504].score == 0
    assert all(set(r.base_labels.split(",")) <= set(r.labels.split(",")) or not r.base_labels for r in rows)
    assert ls.license_scan(frame.limit(0), templates).collect() == []


def test_order_and_partitions_do_not_matter(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    templates = spark.createDataFrame(ls.TEMPLATES, "label string, body string")
    once = sorted(map(str, ls.license_scan(docs, templates).collect()))
    assert once == sorted(map(str, ls.license_scan(docs.repartition(7), templates).collect()))
    assert any("apache" in r for r in once)


def test_many_and_short_templates(spark, monkeypatch):
    frame = spark.createDataFrame(make(), "doc_id long, text string")
    templates = spark.createDataFrame(ls.TEMPLATES, "label string, body string")
    once = sorted(map(str, ls.license_scan(frame, templates).collect()))
    monkeypatch.setattr(ls, "BROADCAST_GRAMS", 3)
    assert once == sorted(map(str, ls.license_scan(frame, templates).collect()))
    with pytest.raises(ValueError, match="fewer"):
        ls.license_scan(frame, spark.createDataFrame([("mit", "mit license")], "label string, body string"))


def body_of(label, i=0):
    return [body for name, body in ls.TEMPLATES if name == label][i]


def test_whole_notices_beside_repeated_words(spark):
    """Words of a notice that are repeated before or after it move no other span."""
    mit, bsd = body_of("mit"), body_of("bsd-3")
    half = bsd.split()
    docs = [
        "permission is hereby granted " * 300 + mit,
        mit + " portions of the software" * 300,
        bsd + " specific prior written permission" * 40,
        "permission is hereby granted " * 50 + mit + " portions of the software" * 50 + " some prose " * 30 + mit,
        "permission is hereby granted " * 300,
        "specific prior written permission " * 40,
        # Edited notices: the parts lie on neighbouring diagonals, with and without repeats around them.
        " ".join([*half[:13], "really", *half[13:]]),
        " ".join([*half[:13], *half[14:]]),
        "may be used to endorse " * 20 + " ".join([*half[:13], "really", *half[13:]]) + " specific prior written permission" * 9,
        " ".join([*half[:9], "and some words more than a gap " * 6, *half[9:18]]),
    ]
    frame = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    rows = {r.doc_id: (r.labels, r.score) for r in ls.license_scan(frame, spark.createDataFrame(ls.TEMPLATES, "label string, body string")).collect()}
    assert [rows[i] for i in range(4)] == [("mit", 1.0), ("mit", 1.0), ("bsd-3", 1.0), ("mit", 1.0)]
    assert rows[4] == rows[5] == ("", 0.0)
    assert [rows[i][0] for i in (6, 7, 8)] == ["bsd-3"] * 3
    assert all(0.8 <= rows[i][1] <= 1 for i in (6, 7, 8))
    assert rows[9] == ("", 0.0)
