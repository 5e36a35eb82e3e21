import random
import re

import duckdb

from skeinwork.llm import oracles, substring_dedup

UNSPACED = "฀-๿　-鿿豈-﫿"
TOKEN = re.compile(f"(?:[{UNSPACED}]|[^ \t\n\x0b\x0c\r{UNSPACED}]+)[ \t\n\x0b\x0c\r]*")
WS = " \t\n\x0b\x0c\r"
UPPER = {c: c + 32 for c in range(65, 91)}


def brute_sentences(text):
    """(words, text) of every sentence."""
    head = text[: len(text) - len(text.lstrip(WS))]
    tokens = TOKEN.findall(text)
    words = [t.rstrip(WS).translate(UPPER) for t in tokens]
    n = len(words)
    first = [i == 0 or "\n" in tokens[i - 1] or bool(re.search(r"(?:[.!?][\"')\]]?|^[。！？])$", words[i - 1])) for i in range(n)]
    places = {min(range(i, i + 10), key=lambda j: (words[j].encode(), j)) for i in range(n - 9)}
    near = [any(first[max(0, i - 5) : i + 6]) for i in range(n)]
    starts = [i for i in range(n) if first[i] or (i in places and not near[i])] + [n]
    out = [(words[a:b], "".join(tokens[a:b])) for a, b in zip(starts, starts[1:], strict=False)]
    return [(w, (head if i == 0 else "") + t) for i, (w, t) in enumerate(out)]


def brute_remove(docs, min_words=40):
    """docs: (doc_id, text) in order; returns (doc_id, text, removed)."""
    seen, out = set(), []
    for d, text in docs:
        units, gone = brute_sentences(text or ""), set()
        for i in range(len(units)):
            run, j = [], i
            while j < len(units) and (j < i + 2 or len(run) < min_words):
                run += units[j][0]
                j += 1
            if j >= i + 2 and len(run) >= min_words:
                if tuple(run) in seen:
                    gone.update(range(i, j))
                seen.add(tuple(run))
        out.append((d, "".join(t for i, (_, t) in enumerate(units) if i not in gone) if gone else text, len(gone)))
    return out


def make(rng):
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(3))
    fresh = lambda n: " ".join(word() for _ in range(n))
    table, short, exact = fresh(60), fresh(39), fresh(60) + ". " + fresh(3) + ".\n"
    pool = [fresh(rng.randrange(2, 40)) + rng.choice([".", "!", "?\n", '."', ".)"]) for _ in range(12)]
    docs = []
    for i in range(60):
        parts = [fresh(rng.randrange(0, 40))] + [rng.choice([table, short, table.upper(), *pool]) for _ in range(rng.randrange(0, 5))]
        rng.shuffle(parts)
        docs.append((i, rng.choice([" ", "\n", "  "]).join(parts)))
    han = "".join(chr(0x4E00 + rng.randrange(3000)) for _ in range(120))
    docs += [(100, exact), (101, exact), (102, "\n één " + exact), (103, han + "。 "), (104, "前" + han[5:] + "。后"), (105, "x " * 300)]
    return docs + [(106, None), (107, ""), (108, " \n "), (109, "Same one here. " * 40), (110, "y" * 200000), (111, "  " + exact + " tail")]


def test_matches_brute_force_and_sql(spark):
    docs = make(random.Random(3))
    frame = spark.createDataFrame([(d, t, 1, "b") for d, t in docs], "doc_id long, text string, h1 int, place string")
    got = sorted((r.doc_id, r.text, r.n_removed) for r in substring_dedup.substring_dedup(frame.repartition(5)).collect())
    assert got == sorted(brute_remove(docs))
    assert sum(x[2] for x in got) > 50
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", docs)
    sql = con.execute(f"SELECT doc_id, text, n_removed FROM ({oracles.ORACLES['op4_substring_dedup']})").fetchall()
    assert sorted(sql) == got


def test_passage_between_other_words(spark):
    """60 words that begin and end inside sentences, without any stop of their own."""
    rng = random.Random(1)
    fresh = lambda n: " ".join("".join(rng.choice("abcdefghij") for _ in range(4)) for _ in range(n))
    total = 60
    docs = []
    for k in range(total):
        passage = fresh(60)
        docs += [(2 * k, f"{fresh(rng.randrange(40))} {passage} {fresh(rng.randrange(40))}."), (2 * k + 1, f"{fresh(9)}. {fresh(rng.randrange(40))} {passage} {fresh(30)}")]
    out = substring_dedup.substring_dedup(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert all(r.n_removed == 0 for r in out if r.doc_id % 2 == 0)
    # Chance decides where sentences are cut, so no passage of 60 words is sure to be found.
    assert sum(r.n_removed > 0 for r in out if r.doc_id % 2) >= 0.95 * total


def test_short_repeats_stay(spark):
    notice = "All rights are reserved by the owner. No part may be copied. Ask us first, then wait. "
    docs = [(i, f"Text {i} begins. {notice}And {i} ends.") for i in range(50)]
    out = substring_dedup.substring_dedup(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.text) for r in out) == docs


def test_null_and_repeated_rows(spark):
    long, other = (" ".join(f"{c}{i}" for i in range(70)) + ". " + " ".join(f"{c}{c}{i}" for i in range(70)) for c in "wz")
    rows = [(5, long, "1", 0), (5, long, "2", 0), (5, other, "3", 0), (6, "Before it. " + long, "4", 0), (None, other, "5", 0), (None, None, "6", 0), (None, long + " " + other, "7", 0)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, starts string, `key` int")
    out = substring_dedup.remove_repeated_spans(frame)
    row = out.select("row.*", "n_removed")
    assert row.columns == [*frame.columns, "n_removed"]
    got = {r.starts: (r.doc_id, r.text, r.key) for r in row.collect()}
    assert got["1"][1] == got["2"][1] and got["6"] == (None, None, 0) and len(got) == 7
    # Every sentence of both passages is left exactly once.
    kept = [got[k][1] for k in "134567"]
    for passage in (long, other):
        for sentence in passage.split(". "):
            assert sum(sentence[:200] in (t or "") for t in kept) == 1
    assert got["4"][1] == "Before it. "
    assert substring_dedup.substring_dedup(frame.limit(0)).collect() == []
