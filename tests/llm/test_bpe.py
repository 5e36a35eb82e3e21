import hashlib
import random

import pytest
import tiktoken

from skeinwork.llm import bpe, queries


@pytest.fixture(scope="module")
def codec():
    path, pattern = queries.tokenizer_file()
    return bpe.BytePairCodec(bpe.read_vocabulary(path), pattern)


@pytest.fixture(scope="module")
def library(codec):
    return tiktoken.Encoding("own", pat_str=queries.tokenizer_file()[1], mergeable_ranks=codec.rank, special_tokens={})


def test_equals_the_library(codec, library):
    rng = random.Random(1)
    letters = "abcdefghijklmnop éüñß\n\t  '#.,0123你好aaaeeesttt \x1c\x85\u2003\U0001f600"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(80))) for _ in range(1500)]
    texts += ["a" * 30000, "ab" * 9000, "=" * 5000, " " * 3000, "".join(rng.choice("etaoins") for _ in range(30000)), "it's we'll  \n\n x "]
    for t in texts:
        ids = codec.encode(t)
        assert ids == library.encode_ordinary(t)
        assert codec.decode(ids) == t.encode()
        assert codec.digests(t) == digests(library, t)


def digests(library, text):
    ids = library.encode_ordinary(text)
    return len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()


def test_long_texts_in_parts(codec, library, monkeypatch):
    monkeypatch.setattr(bpe, "LONG_TEXT", 20)
    monkeypatch.setattr(bpe, "PIECES", 3)
    for t in ("", "one two", "it's  a long, long text 123 of\n\n many pieces é " * 5):
        assert codec.encode(t) == library.encode_ordinary(t)
        assert codec.digests(t) == digests(library, t)


def test_vocabulary_without_some_bytes():
    small = bpe.BytePairCodec(b"YQ== 0\nYg== 1\n", ".")
    assert small.encode("ab") == [0, 1]
    with pytest.raises(ValueError, match="lacks"):
        small.encode("ac")


def test_memo_turns_over(codec, library, monkeypatch):
    monkeypatch.setattr(codec.memo, "entries", 5)
    monkeypatch.setattr(bpe, "PAIR_ENTRIES", 5)
    for i in range(200):
        t = f"word{i} other{i % 7}, thing{i * i}"
        assert codec.encode(t) == library.encode_ordinary(t)
        assert codec.digests(t) == digests(library, t)


def test_operator(spark, library):
    docs = [(1, "Hello wörld"), (2, None), (3, ""), (None, "x  y"), (1, "Hello wörld"), (4, "z " * 40000)]
    frame = spark.createDataFrame([(d, t, 5, "q") for d, t in docs], "doc_id long, text string, n_tokens int, raw string")
    path, pattern = queries.tokenizer_file()
    rows = bpe.bpe_encode(frame, path, pattern, keep_ids=True).collect()
    want = []
    for d, t in docs:
        ids = library.encode_ordinary(t or "")
        want.append((str(d), len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
        assert any(list(r.ids) == ids and bytes(r.decoded) == (t or "").encode() for r in rows)
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in rows) == sorted(want)
    assert bpe.bpe_encode(frame.limit(0), path, pattern).collect() == []
