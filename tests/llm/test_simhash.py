import random
from collections import defaultdict

import xxhash

from skeinwork.llm import simhash

LETTERS = "abcdefghij"


def brute_fingerprint(text):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").replace("\t", " ").replace("\n", " ").replace("\r", " ").replace("\x0b", " ").replace("\x0c", " ").split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def brute_components(fps):
    """fps: list of (doc_id, fp)."""
    parent = list(range(len(fps)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i][1] ^ fps[j][1]).bit_count() <= 2:
                parent[find(i)] = find(j)
    least = defaultdict(list)
    for i, (d, _) in enumerate(fps):
        if d is not None:
            least[find(i)].append(d)
    return [min(least[find(i)], default=None) for i in range(len(fps))]


def make_docs():
    rng = random.Random(5)
    word = lambda: "".join(rng.choice(LETTERS) for _ in range(3))
    docs = []
    for i in range(120):
        docs.append((i * 3 + 1, " ".join(word() for _ in range(rng.choice([1, 2, 3, 8, 60])))))
    base = [word() for _ in range(400)]
    for i in range(30):
        near = list(base)
        near[rng.randrange(400)] = word()
        docs.append((1000 - i, " ".join(near)))
    docs += [(2000, None), (2001, ""), (2002, " \t\n"), (7, docs[2][1]), (None, docs[3][1]), (2003, "Ab  cD\x0b É ß")]
    docs += [docs[0], docs[0], (2004, "x " * 30000)]
    return docs


def test_matches_brute_force(spark):
    docs = make_docs()
    frame = spark.createDataFrame([(d, t, 0, "c") for d, t in docs], "doc_id long, text string, fp int, code string")
    got = sorted((str(r.doc_id), r.fingerprint, r.component_id) for r in simhash.near_duplicate_groups(frame).collect())
    fps = [(d, brute_fingerprint(t)) for d, t in docs]
    want = sorted((str(d), f"{fp:016x}", c) for (d, fp), c in zip(fps, brute_components(fps), strict=True))
    assert got == want
    assert len({c for _, _, c in want}) < len(want)


def test_links_across_tiles(spark):
    rng = random.Random(9)
    fps = {rng.getrandbits(64) for _ in range(300)}
    for fp in list(fps)[:150]:
        near = fp
        for _ in range(4):
            near ^= 1 << rng.randrange(64)
            near ^= 1 << rng.randrange(64)
            fps.add(near)
    fps = sorted(fps)
    signed = [(i, fp - (1 << 64) if fp >> 63 else fp) for i, fp in enumerate(fps)]
    known = spark.createDataFrame(signed, "doc_id long, fp long")
    got = {r.doc_id: r.component_id for r in simhash._with_components(known, 2).collect()}
    want = brute_components([(i, fp) for i, fp in enumerate(fps)])
    assert [got[i] for i in range(len(fps))] == want


def test_keep_first_and_empty(spark):
    docs = spark.createDataFrame([(3, "a b c d", 1), (2, "a b c d", 2), (9, "z y x w", 3), (None, "q r s", 4), (None, "q r s", 5)], "doc_id long, text string, __x int")
    kept = simhash.keep_first(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["2", "9", "None"]
    assert simhash.near_duplicate_groups(docs.limit(0)).collect() == []


def jaccard(a, b):
    a, b = ({tuple(t.split()[i : i + 5]) for i in range(max(1, len(t.split()) - 4))} for t in (a, b))
    return len(a & b) / len(a | b)


def test_keep_similar(spark, monkeypatch):
    """Texts alike by 0.9 and more go, those below 0.6 stay; a dense group gives one."""
    monkeypatch.setattr(simhash, "STRIP", 200)
    rng = random.Random(3)
    word = lambda: "".join(rng.choice(LETTERS) for _ in range(4))
    docs, near, far = [], [], []
    for k in range(60):
        base = [word() for _ in range(300)]
        near_copy, far_copy = list(base), list(base)
        for i in rng.sample(range(300), 2):
            near_copy[i] = word()
        for i in range(0, 300, 11):
            far_copy[i] = word()
        texts = [" ".join(x) for x in (base, near_copy, far_copy)]
        assert jaccard(texts[0], texts[1]) >= 0.9 and jaccard(texts[0], texts[2]) < 0.6
        docs += [(10 * k, texts[0], 1), (10 * k + 1, texts[1], 2), (10 * k + 2, texts[2], 3)]
        near.append(10 * k + 1)
        far += [10 * k, 10 * k + 2]
    hot = [word() for _ in range(400)]
    for i in range(150):
        copy = list(hot)
        copy[rng.randrange(400)] = word()
        docs.append((5000 + i, " ".join(copy), 4))
    docs += [(None, None, 5), (9000, "", 6), (9001, "one two", 7), (9002, "one  TWO", 8), (9003, "one three", 9)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, key int")
    kept = simhash.keep_similar(frame)
    assert kept.columns == frame.columns
    got = {r.doc_id for r in kept.collect()}
    assert set(far) <= got and not got & set(near)
    assert {d for d in got if d is not None and d >= 5000} == {5000, 9000, 9001, 9003}
    assert simhash.keep_similar(frame.limit(0)).collect() == []


def test_rows_that_differ_in_other_columns_only(spark):
    """Which of them stays depends on the rows, not on their order or partitions."""
    text = "one two three four five six seven eight nine ten"
    rows = [(1, text, "p", 3), (1, text, "q", 3), (1, text, "p", 3), (2, text, "a", 3), (None, "other words here", None, 1), (None, "other words here", "z", 1)]
    for keep in (simhash.keep_first, simhash.keep_similar):
        kept = set()
        for order in (rows, rows[::-1], rows[2:] + rows[:2]):
            docs = spark.createDataFrame(order, "doc_id long, text string, source string, node int").repartition(3)
            kept.add(tuple(sorted(map(str, keep(docs).collect()))))
        assert len(kept) == 1 and len(next(iter(kept))) == 2
