import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from skeinwork.llm import merkle

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, tree string, at int, digest string, n int, `row.part` int"


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, text):
    values = [row[0], row[1], row[2], row[3], text]
    return sha(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        last = out[-1]
        out.append([sha(*last[i : i + 8]) for i in range(0, len(last), 8)])
    return out


def steps(tree, i):
    out = []
    for nodes in tree[:-1]:
        start = i - i % 8
        run = nodes[start : start + 8]
        out.append(("".join(run[: i - start]), "".join(run[i - start + 1 :])))
        i //= 8
    return out


def brute(rows):
    """Rows of (doc_id, leaf, subroot, root, proof_sha256, folded_root, verified)."""
    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    trees, members = [], []
    for lang in langs:
        own = sorted((r for r in rows if r[2] == lang), key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[4])))
        members.append(own)
        trees.append(levels([leaf(r, r[4]) for r in own]))
    top = levels([t[-1][0] for t in trees])
    out = []
    for place, (tree, own) in enumerate(zip(trees, members, strict=True)):
        for i, r in enumerate(own):
            path = steps(tree, i) + steps(top, place)
            now = r[4]
            if now is not None and r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0:
                now = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in now)
            node = leaf(r, now)
            for a, b in path:
                node = sha(a, node, b)
            root = top[-1][0]
            out.append((r[0], leaf(r, r[4]), tree[-1][0], root, sha(*[a + b for a, b in path]), node, node == root))
    return out


def rows_of(seed, n):
    rng = random.Random(seed)
    langs = ["en"] * 5 + ["de", "é", "zz", None, "Z"]
    rows = []
    for i in range(n):
        text = rng.choice(["", "Ab C", "é\n" * 3, "x" * 2000, None, f"Text {i}"])
        rows.append((rng.choice([i, i // 2, None]) if rng.random() < 0.3 else i, rng.choice(["s", "", None]), rng.choice(langs), rng.choice([None, 3]), text))
    rows += [(7, "hot", "en", 1, "A copy")] * (n // 3)
    rows.append((1, "s", "alone", 1, "ONE"))
    return rows


def frame(spark, rows, parts=5):
    return spark.createDataFrame([(*r, "t", 1, "d", 2, 3) for r in rows], SCHEMA).repartition(parts)


@pytest.mark.parametrize(("seed", "n", "block_levels"), [(1, 300, 1), (2, 700, 2), (3, 40, 3), (4, 9, 1)])
def test_equals_whole_trees(spark, monkeypatch, seed, n, block_levels):
    monkeypatch.setattr(merkle, "BLOCK_LEVELS", block_levels)
    rows = rows_of(seed, n)
    docs = frame(spark, rows)
    found = merkle.verified_manifest(docs, merkle.tampered_text(docs)).collect()
    key = repr
    assert sorted((tuple(r) for r in found), key=key) == sorted(brute(rows), key=key)
    assert {r.verified for r in found} == {True, False}


def test_one_row_and_none(spark):
    one = [(3, "s", None, 4, "Abc")]
    docs = frame(spark, one)
    found = merkle.verified_manifest(docs, merkle.tampered_text(docs)).collect()
    assert [tuple(r) for r in found] == brute(one)
    assert found[0].subroot == found[0].root == found[0].leaf
    assert found[0].proof_sha256 == sha("")
    none = frame(spark, one).filter("doc_id < 0")
    assert merkle.verified_manifest(none, F.col("text")).collect() == []


def test_traversal_keeps_few_nodes():
    """What the stacks and runs hold stays in the levels, not in the leaves."""
    leaves = [sha(str(i)).encode() for i in range(1500)]
    tree = levels([x.decode() for x in leaves])
    height = len(tree) - 1
    for i, path in enumerate(merkle.traverse(leaves.__getitem__, len(leaves), height)):
        assert [(a.decode(), b.decode()) for a, b in path] == steps(tree, i)
    stack = merkle.Treehash(height)
    most = 0
    for x in leaves:
        stack.add(x)
        most = max(most, sum(map(len, stack.runs)))
    assert most <= merkle.FANOUT * (height + 1)


def test_proof_of_one_row_suffices(spark):
    rows = rows_of(5, 60)
    made = merkle.merkle_manifest(frame(spark, rows))
    assert made.columns == ["doc_id", "lang", "leaf", "subroot", "root", "proof"]
    checked = made.select((merkle.folded(F.col("leaf"), F.col("proof")) == F.col("root")).alias("ok")).collect()
    assert len(checked) == len(rows)
    assert all(r.ok for r in checked)
