import math
import random
import zlib
from collections import Counter

import numpy as np

from skeinwork.llm import lm


def brute(docs):
    split = lambda t: [w for w in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "").replace("\n", " ").replace("\t", " ").split(" ") if w] + [None]
    held = lambda d: zlib.crc32(("" if d is None else str(d)).encode()) % 7 == 2
    counts = Counter(w for d, t in docs if not held(d) for w in split(t))
    n, v = sum(counts.values()), len(counts)
    out = []
    for d, t in docs:
        ws = split(t)
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in ws)
        out.append((str(d), held(d), len(ws), sum(counts[w] > 0 for w in ws), n, round(base, 6)))
    return sorted(out)


def corpus():
    rng = random.Random(3)
    pairs = ["the cat", "a dog", "Some birds", "é ß", "x"]
    docs = [(i, " ".join(rng.choice(pairs) if rng.random() < 0.8 else f"w{rng.randrange(900)}" for _ in range(rng.randrange(90)))) for i in range(300)]
    return docs + [(900, None), (901, ""), (902, " \n\t"), (None, "the cat"), (3, docs[3][1]), (903, "long" * 400 + " the"), (904, "long" * 400)]


def test_base_and_learning(spark, monkeypatch):
    monkeypatch.setattr(lm, "SENT_WORDS", 80)
    docs = corpus()
    frame = spark.createDataFrame([(d, t, 1, 2.0) for d, t in docs], "doc_id long, text string, rid int, score double")
    rows = lm.lm_scores(frame).collect()
    got = sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in rows)
    assert got == brute(docs)
    held = [r for r in rows if r.held_out and r.n_tokens > 10]
    assert sum(r.score for r in held) > sum(r.base_score for r in held) + 10
    assert all(r.score < 0 for r in rows)


def test_probabilities_are_normalised():
    rng = np.random.default_rng(1)
    counts = np.zeros((lm.CLASSES,) * 3)
    counts[lm.START, lm.START, 3] = 500
    counts[lm.START, 3, 5] = 500
    counts[3, 5, lm.END] = 500
    counts[: lm.START, : lm.START, : lm.START] += rng.random((lm.START,) * 3) < 0.001
    table = 10 ** lm.train(counts)
    assert np.allclose(table.sum(2), 1)
    assert table[lm.START, 3, 5] > 0.8


def test_empty_and_untrained(spark):
    frame = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    assert lm.lm_scores(frame.limit(0)).collect() == []
    out = [d for d in range(100) if zlib.crc32(str(d).encode()) % 7 == 2][:2]
    rows = lm.lm_scores(spark.createDataFrame([(d, "a b") for d in out], "doc_id long, text string")).collect()
    assert {(r.train_tokens, r.n_known, r.base_score) for r in rows} == {(0, 0, 0.0)}


def test_score_matches_brute_force(spark, monkeypatch):
    """Both levels restated from the net's table, and their probabilities sum to one."""
    made = {}

    def here(_, make, *args):
        made[make.__name__] = make(*args)
        return made[make.__name__]

    word_classes = lm.word_classes
    monkeypatch.setattr(lm, "in_task", here)
    monkeypatch.setattr(lm, "word_classes", lambda *a: made.setdefault("classes", word_classes(*a)))
    monkeypatch.setattr(lm, "CLASSED_WORDS", 120)
    docs = corpus()
    rows = lm.lm_scores(spark.createDataFrame(docs, "doc_id long, text string").repartition(3)).collect()
    classes, table = made["classes"], made["train"].astype(np.float32).astype(float)
    assert len(classes) == 120 and len(set(classes.values())) > lm.SINGLES
    split = lambda t: [w for w in (t or "").encode().lower().split()]
    counts = Counter(w for d, t in docs if zlib.crc32(("" if d is None else str(d)).encode()) % 7 != 2 for w in split(t))
    totals = Counter()
    for w, c in counts.items():
        totals[classes.get(w, lm.OTHER)] += c + 1

    def inner(w):
        c = classes.get(w, lm.OTHER)
        return (counts[w] + 1) / (totals[c] + (c == lm.OTHER))

    want = []
    for d, t in docs:
        ws, total, before = split(t), 0.0, (lm.START, lm.START)
        for w in [*ws, None]:
            c = lm.END if w is None else classes.get(w, lm.OTHER)
            total += table[before[0], before[1], c] + (0 if w is None else math.log10(inner(w)))
            before = (before[1], c)
        want.append((str(d), len(ws) + 1, round(total, 3)))
    assert sorted((str(r.doc_id), r.n_tokens, round(r.score, 3)) for r in rows) == sorted(want)
    for before in ((lm.START, lm.START), (3, lm.OTHER), (lm.OTHER, 60)):
        every = sum(10 ** table[before][classes.get(w, lm.OTHER)] * inner(w) for w in counts) + 10 ** table[before][lm.END]
        unknown = 10 ** table[before][lm.OTHER] / (totals[lm.OTHER] + 1)
        assert abs(every + unknown - 1) < 1e-4


def test_clusters_follow_neighbours():
    rng = np.random.default_rng(2)
    kinds = rng.integers(0, 4, 500)
    counts = rng.poisson(np.eye(4)[kinds].repeat(8, axis=1) * 20 + 0.2).astype(float)
    of = lm.clustered(counts, np.ones(500), 4)
    assert len({(a, b) for a, b in zip(kinds.tolist(), of.tolist(), strict=True)}) == 4
