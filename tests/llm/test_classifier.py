import random

from skeinwork.llm import classifier


def make(n=500):
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 6)))
    docs, labels = [], []
    for i in range(n):
        ws = [word() for _ in range(rng.randrange(30, 120))]
        low, toxic = i % 9 == 0, i % 7 == 0
        if low:
            ws = [w + rng.choice(["###", "***", "%%%"]) for w in ws]
        if toxic:
            for _ in range(3):
                ws[rng.randrange(len(ws))] = rng.choice(["vileword", "nastyword", "vileling"])
        docs.append((i, " ".join(ws), "en", f"s{i % 5}", sum(map(len, ws))))
        if i % 2:
            labels.append((i, int(not low), int(toxic)))
    return docs, labels


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string, low int"


def test_learns_and_scores_all(spark):
    docs, labels = make()
    extra = [(900, None, None, None, None), (901, "", "en", "s1", 0), (None, "abc def", "en", "s1", 7), docs[0], (902, "w " * 30000, "zz", "new", -5)]
    frame = spark.createDataFrame([(*d, "x", 1) for d in docs + extra], SCHEMA)
    known = spark.createDataFrame([(*x, "t") for x in labels + labels[:3] + [(None, 0, 1), (3, None, None)]], "doc_id long, quality int, toxic int, text string")
    rows = classifier.classify(frame, known).collect()
    assert len(rows) == len(docs) + len(extra)
    held = [r for r in rows if r.doc_id is not None and r.doc_id < len(docs) and r.doc_id % 2 == 0]
    right = sum(r.kept == (r.doc_id % 9 != 0 and r.doc_id % 7 != 0) for r in held)
    assert right / len(held) > 0.95
    good = classifier.keep_good(frame, known)
    assert good.columns == frame.columns and good.count() == sum(r.kept for r in rows)


def test_nothing_to_learn(spark):
    docs, labels = make(20)
    frame = spark.createDataFrame([(*d, "x", 1) for d in docs], SCHEMA)
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    assert all(r.kept and r.score == 1 for r in classifier.classify(frame, known.limit(0)).collect())
    assert classifier.classify(frame.limit(0), known).collect() == []


def test_pseudo_labels_come_from_the_whole_table(spark, monkeypatch):
    """The surest documents of all partitions by brute force, each vector once, without those done."""
    import numpy as np

    monkeypatch.setattr(classifier, "HANDED_OVER", 7)
    rng = np.random.default_rng(4)

    def logistic(w):
        out = classifier.Logistic()
        out.w, out.b = w.astype(np.float32), 0.1
        return out

    text, meta = rng.normal(0, 4, 20 + classifier.STYLE), rng.normal(0, 4, classifier.META)
    model = classifier.CoTrained(np.zeros(classifier.STYLE), np.ones(classifier.STYLE), [logistic(text), logistic(meta)], [], None)
    rows = []
    for i in range(400):
        style = rng.normal(0, 0.1, classifier.STYLE).astype(np.float32).tolist()
        rows.append(([int(x) for x in rng.choice(20, 4, replace=False)], style, [int(x) for x in rng.choice(classifier.META, 5, replace=False)], i))
    pool = spark.createDataFrame([*rows, *rows[:50]], classifier.VECTOR_SQL).repartition(9)
    done = {3, 5, 8, 13, 21}
    want = set()
    for view in (0, 1):
        for label in (0, 1):
            odds = {}
            for t, s, m, mark in rows:
                x = (text[t].sum() + np.dot(text[20:], s) if view == 0 else meta[m].sum()) + 0.1
                odds[mark] = x if label else -x
            least = np.log(classifier.SURE / (1 - classifier.SURE))
            sure = [k for k in odds if k not in done and odds[k] >= least]
            want |= {(view, label, k) for k in sorted(sure, key=lambda k: (-round(min(odds[k], 30), 4), k))[:7]}
    got = {(v, k, m) for v, k, m, _ in classifier.surest(pool, model, done)}
    assert len(want) == 28 and len(got & want) >= 26 and len(got) == 28


def test_scores_restated(spark):
    """What a fitted model gives a batch, against the same sums by row."""
    import math

    import numpy as np
    import pyarrow as pa

    rng = np.random.default_rng(9)
    examples = []
    for i in range(120):
        text = sorted(int(x) for x in rng.choice(12, 3, replace=False)) + ([12] if i % 3 else [])
        examples.append(classifier._example(text, rng.normal(size=classifier.STYLE).tolist(), [int(x) for x in rng.choice(classifier.META, 5)]))
    y = np.array([int(i % 3 > 0) for i in range(120)])
    model = classifier.fit(13, examples, y, [[(examples[0], 0)], [(examples[1], 1), (examples[2], 1)]])
    kinds = dict(classifier._VECTOR)
    batch = pa.RecordBatch.from_arrays([pa.array([getattr(e, c) for e in examples], type=kinds[c]) for c in ("text", "style", "meta")], names=["text", "style", "meta"])
    got = model.joined(model.view_odds(batch.slice(5, 100)))
    content, meta = model.models
    for e, score in zip(examples[5:105], got, strict=True):
        style = (np.array(e.style) - model.mean) / model.spread
        odds = (sum(content.w[t] for t in e.text) + style @ content.w[13:] + content.b, sum(meta.w[m] for m in e.meta) + meta.b)
        joint = sum(w * (s.w[0] * o / 10 + s.b) for w, s, o in zip(model.joint.w, model.scale, odds, strict=True)) + model.joint.b
        assert abs(score - 1 / (1 + math.exp(-joint))) < 1e-3
    assert np.mean((got > 0.5) == (y[5:105] == 1)) > 0.95
