import hashlib
import random
import zlib
from collections import Counter, defaultdict

import pytest

from skeinwork.llm import sharding


def brute_capacity(sizes, shards):
    total, low, high = sum(sizes), max(sizes), sum(sizes)

    def feasible(c):
        used, room = 1, c
        for s in sizes:
            if s > room:
                used, room = used + 1, c
            room -= s
        return used <= shards

    low = max(low, -(-total // shards))
    while low < high:
        mid = (low + high) // 2
        low, high = (low, mid) if feasible(mid) else (mid + 1, high)
    return low


def rows(seed, n):
    rng = random.Random(seed)
    texts = ["x" * rng.choice([0, 1, 5, 40, 400]) + str(rng.randrange(n)) for _ in range(n)]
    docs = list(enumerate(texts))
    docs += [(n + i, "the hot copy é") for i in range(n // 3)]
    docs += [(-1, None), (-2, ""), (None, "a"), (None, "a"), (5, texts[5])]
    return docs


@pytest.mark.parametrize(("seed", "n", "shards", "digits"), [(1, 400, 24, 4), (2, 300, 7, 1), (3, 400, 24, 2), (4, 60, 24, 1)])
def test_minimax(spark, monkeypatch, seed, n, shards, digits):
    monkeypatch.setattr(sharding, "FIRST_DIGITS", digits)
    monkeypatch.setattr(sharding, "MORE_DIGITS", 1)
    monkeypatch.setattr(sharding, "LANE_ROWS", 10)
    docs = rows(seed, n)
    frame = spark.createDataFrame([(d, t, 1, "z") for d, t in docs], "doc_id long, text string, lane int, gkey string")
    out = sharding.shard(frame, shards).collect()
    assert len(out) == len(docs)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in out) == Counter(
        (d, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for d, t in docs
    )
    groups = defaultdict(int)
    for _, t in docs:
        raw = (t or "").encode()
        groups[hashlib.md5(raw).hexdigest()] += len(raw) + 8
    shard_bytes, slots = Counter(), defaultdict(list)
    for r in out:
        shard_bytes[r.shard] += r.size
        slots[r.shard].append(r.slot)
    assert max(shard_bytes.values()) == brute_capacity([groups[k] for k in sorted(groups)], shards)
    assert set(slots) <= set(range(shards))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert len({(r.text_crc32, r.size, r.shard) for r in out}) == len({(r.text_crc32, r.size) for r in out})
    assert {r.law for r in out} == {"bytes"} and {r.grown_shard for r in out} == {None}


def test_empty_and_few(spark):
    frame = spark.createDataFrame([(1, "a"), (2, "b")], "doc_id long, text string")
    assert sharding.shard(frame.limit(0)).collect() == []
    assert sorted(r.slot for r in sharding.shard(frame).collect()) == [0, 0]


def test_capacity_matches_search_over_all_groups(spark, monkeypatch):
    """From few wide ranges to single groups, over sizes from equal to very unequal."""
    monkeypatch.setattr(sharding, "FIRST_DIGITS", 1)
    monkeypatch.setattr(sharding, "MORE_DIGITS", 1)
    rng = random.Random(8)
    for largest, n, shards in ((1, 700, 24), (30, 900, 24), (5000, 800, 5), (3, 20, 24)):
        keys = {hashlib.md5(str(rng.random()).encode()).hexdigest(): rng.randrange(1, largest + 1) for _ in range(n)}
        capacity, cuts = sharding.minimax_cuts(spark.createDataFrame(list(keys.items()), "gkey string, bytes long"), shards)
        assert capacity == brute_capacity([keys[k] for k in sorted(keys)], shards)
        parts = Counter()
        for k, size in keys.items():
            parts[sum(k > c + "g" for c in cuts)] += size
        assert len(cuts) < shards and max(parts.values()) <= capacity


def test_hot_group_and_ids_in_steps(spark):
    """A group of a third of the rows, and ids that are all multiples of 64, over 211 partitions."""
    n = 6000
    docs = [(64 * i, "the hot copy" if i % 3 == 0 else f"text {i}") for i in range(n)] + [(None, None)] * 1000
    spark.conf.set("spark.sql.shuffle.partitions", "211")
    try:
        frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(7)
        out = sharding.shard(frame)
        rows = out.collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    assert len(rows) == len(docs) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) > 2 * sharding.LANE_ROWS
