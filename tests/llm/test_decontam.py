import hashlib
import random
import re

import pytest

from skeinwork.llm import decontam

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items):
    windows = set()
    for item, text in items:
        ws = words(text)
        for i in range(max(1, len(ws) - 9) if ws else 0):
            windows.add((tuple(ws[i : i + 10]), "null" if item is None else str(item)))
    out = []
    for d, text in docs:
        ws, hit, found = words(text), set(), set()
        for w, item in windows:
            for i in range(len(ws) - len(w) + 1):
                if tuple(ws[i : i + len(w)]) == w:
                    hit.update(range(i, i + len(w)))
                    found.add(item)
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((str(d), len(ws), len(hit), len(found), digest, bool(hit)))
    return sorted(out)


def data():
    rng = random.Random(2)
    vocabulary = ["the", "Cat", "Éa", "x1", "run", "über"]
    text = lambda n: rng.choice(["", "--"]) + "".join(rng.choice(vocabulary) + rng.choice([" ", ", ", "\n", " (", "é "]) for _ in range(n))
    items = [(i, text(rng.choice([1, 4, 9, 10, 11, 25]))) for i in range(30) if i % 3] + [(50, None), (51, "..."), (None, text(12)), (4, text(13)), (10, text(10)), (2, "cat cat cat")]
    docs = [(i, text(rng.randrange(60)) + " " + (rng.choice(items)[1] or "") + " " + text(5)) for i in range(120)]
    return docs + [(200, None), (201, ""), (202, "?!"), (None, items[3][1]), (3, docs[3][1]), (3, docs[3][1]), (203, "cat " * 30000)], items


@pytest.mark.parametrize(("block", "hashes"), [(1 << 21, 1 << 22), (600, 1 << 22), (600, 50)])
def test_matches_brute_force(spark, monkeypatch, block, hashes):
    monkeypatch.setattr(decontam, "BLOCK_CHARS", block)
    monkeypatch.setattr(decontam, "HASHES", hashes)
    docs, items = data()
    frame = spark.createDataFrame([(d, t, 1, "h", "p") for d, t in docs], "doc_id long, text string, hit int, items string, pattern string")
    bench = spark.createDataFrame([(i, t, "w") for i, t in items], "item_id long, text string, ws string")
    got = decontam.decontaminate(frame, bench).drop("runs").collect()
    assert sorted((str(r.doc_id), *r[1:]) for r in got) == brute(docs, items)


def test_original_spans_and_filter(spark):
    text = "Intro here! The QUICK, brown fox; jumps\nover the lazy dog's tail - end é."
    frame = spark.createDataFrame([(1, text, "a"), (2, "nothing of it", "b"), (3, None, None)], "doc_id long, text string, runs string")
    bench = spark.createDataFrame([(1, "quick brown fox jumps over the lazy dog s tail end")], "item_id long, text string")
    row = decontam.decontaminate(frame, bench).filter("doc_id = 1").first()
    spans = decontam.original_spans(text.encode(), [(r["first"], r["last"]) for r in row.runs])
    assert [text.encode()[a:b].decode() for a, b in spans] == ["QUICK, brown fox; jumps\nover the lazy dog's tail - end"]
    kept = decontam.drop_contaminated(frame, bench)
    assert kept.columns == frame.columns
    assert sorted(r.doc_id for r in kept.collect()) == [2, 3]


def test_large_benchmark_in_one_automaton(spark, monkeypatch):
    """Of many windows only those that occur go into the automaton."""
    monkeypatch.setattr(decontam, "BLOCK_CHARS", 20_000)
    text = lambda k, n: " ".join(f"w{k}x{i}" for i in range(n))
    bench = spark.createDataFrame([(k, text(k, 30)) for k in range(200)], "item_id long, text string")
    docs = spark.createDataFrame([(k, f"before {text(k, 12 if k % 2 else 9)} after", "x") for k in range(40)], "doc_id long, text string, hit string")
    n, windows = decontam._blocks(decontam.item_windows(bench), docs, "text")
    assert n == 1 and windows.count() == 20 * 3
    kept = decontam.drop_contaminated(docs, bench)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == list(range(0, 40, 2))


def test_empty_tables(spark):
    frame = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    bench = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert decontam.decontaminate(frame.limit(0), bench).collect() == []
    row = decontam.decontaminate(frame, bench.limit(0)).first()
    assert (row.n_words, row.n_hit, row.contaminated) == (2, 0, False)
