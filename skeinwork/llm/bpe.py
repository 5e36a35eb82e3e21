"""Byte-level BPE encoding and decoding (operator 2).

A text is split by the tokenizer's pattern.  Each piece is encoded without
replaying merges: one Aho-Corasick pass over the piece (bytes mapped to Latin-1)
finds every vocabulary entry at every place; the encoder then walks from left to
right, takes the longest entry, and backtracks to shorter ones until each
adjacent pair of tokens is *compatible*, that is, until plain merging of their
joint bytes would leave exactly these two tokens.  Such a sequence is unique and
equals the merges' own result.  Places that turned out dead ends are marked, so
each is left once and the work is linear in the piece.  What a piece gives is
remembered, decimals of its ids and all, for the next time it comes.

Null text: encoded like the empty text, with no tokens.  Repeated rows are
encoded row by row; nothing is shuffled.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Callable, Iterator
from itertools import islice

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .common import record_batch, small_batches, utf8

#: Entries in a generation of the memo of pieces (some 200 bytes each), and in the memo
#: of token pairs.  Measured: 97 MB for both in a worker, where 400,000 and 500,000
#: take 166 MB and save no time.
MEMO_ENTRIES = 250_000
PAIR_ENTRIES = 200_000
#: Longer pieces are encoded each time: the memo holds short ones only.
MEMO_PIECE = 64
#: Texts of more characters are split into so many pieces at a time.
LONG_TEXT, PIECES = 1 << 20, 100_000
#: A vocabulary beyond this many bytes is not sent to the executors.
MAX_VOCABULARY_BYTES = 64 << 20


class BytePairCodec:
    """Encodes and decodes with the ranks of a tiktoken vocabulary file."""

    def __init__(self, rank_file: bytes, pattern: str):
        self.token_bytes: dict[int, bytes] = {}
        self.rank: dict[bytes, int] = {}
        for line in rank_file.splitlines():
            if line:
                token, rank = line.split()
                token = base64.b64decode(token)
                self.rank[token] = int(rank)
                self.token_bytes[int(rank)] = token
        self.split = regex.compile(pattern)
        places = max(self.token_bytes, default=-1) + 1
        halves = {r: self._last_merge(b, r) for b, r in self.rank.items() if len(b) > 1}
        self.joined = {pair: r for r, pair in halves.items() if pair}
        #: By rank, the two tokens whose merge makes a token; -1 where there are none.
        self.left, self.right = ([(halves.get(r) or (-1, -1))[i] for r in range(places)] for i in (0, 1))
        self.shorter = [self._longest_prefix(self.token_bytes.get(r, b"")) for r in range(places)]
        self.automaton = ahocorasick.Automaton()
        for token, rank in self.rank.items():
            self.automaton.add_word(token.decode("latin-1"), (rank, len(token) - 1))
        self.automaton.make_automaton()
        self.size = [len(self.token_bytes.get(r, b"")) for r in range(places)]
        self.pairs: dict[tuple[int, int], bool] = {}
        self.memo = _Memo(self._decimals, MEMO_ENTRIES)
        self.decimal = {r: str(r) for r in self.token_bytes}

    def _last_merge(self, token: bytes, below: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes ``token``, from merges of lower rank only."""
        parts = [token[i : i + 1] for i in range(len(token))]
        while len(parts) > 2:
            best, at = below, -1
            for i in range(len(parts) - 1):
                rank = self.rank.get(parts[i] + parts[i + 1], below)
                if rank < best:
                    best, at = rank, i
            if at < 0:
                return None
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        left, right = (self.rank.get(p) for p in parts)
        return None if left is None or right is None else (left, right)

    def _longest_prefix(self, token: bytes) -> int | None:
        for n in range(len(token) - 1, 0, -1):
            if token[:n] in self.rank:
                return self.rank[token[:n]]
        return None

    def compatible(self, left: int, right: int) -> bool:
        """Whether merging the bytes of both tokens leaves just these two.

        Follows the seam between them downwards: of the two tokens that touch it,
        the one merged last is undone first, and a merge across the seam that
        would have come before that point shows that the seam does not survive.
        """
        if len(self.pairs) > PAIR_ENTRIES:
            self.pairs.clear()
        a, b, horizon = left, right, 1 << 62
        joined, lefts, rights = self.joined.get, self.left, self.right
        good = True
        while True:
            across = joined((a, b))
            if across is not None and across < horizon:
                good = False
                break
            undo_a, undo_b = rights[a], lefts[b]
            # Equal tokens merge from the left, so the right one is undone first.
            if undo_a >= 0 and (undo_b < 0 or a > b):
                horizon, a = a, undo_a
            elif undo_b >= 0:
                horizon, b = b + 1, undo_b
            else:
                break
        self.pairs[left, right] = good
        return good

    def _encode_piece(self, piece: str) -> tuple[int, ...]:
        raw = piece.encode()
        whole = self.rank.get(raw)
        if whole is not None:
            return (whole,)
        size, shorter, pairs = self.size, self.shorter, self.pairs
        stop = len(raw)
        longest: list[int | None] = [None] * (stop + 1)
        # Ends come in rising order, so the last entry at a start is its longest.
        for end, (rank, back) in self.automaton.iter(raw.decode("latin-1")):
            longest[end - back] = rank
        dead: set[int] = set()
        token = longest[0]
        out = [token]
        if token is None:
            raise ValueError("the vocabulary lacks a byte of the text")
        at = size[token]
        while at < stop:
            last = out[-1]
            token = longest[at]
            while token is not None:
                if not dead or at + size[token] not in dead:
                    fits = pairs.get((last, token))
                    if fits or fits is None and self.compatible(last, token):
                        break
                token = shorter[token]
            if token is not None:
                out.append(token)
                at += size[token]
                continue
            # Nothing follows ``last`` here: give this place up, try shorter ones before.
            while token is None:
                dead.add(at)
                dropped = out.pop()
                at -= size[dropped]
                token = shorter[dropped]
                while token is not None and (
                    at + size[token] in dead or out and not self.compatible(out[-1], token)
                ):
                    token = shorter[token]
                if token is None and not out:
                    raise ValueError("the vocabulary lacks a byte of the text")
            out.append(token)
            at += size[token]
        return tuple(out)

    def _decimals(self, piece: str) -> bytes:
        """The piece's ids in decimals, once they are seen to decode to the piece."""
        ids = self._encode_piece(piece)
        if self.decode(ids) != piece.encode():
            raise ValueError("the vocabulary does not decode to the bytes it encodes")
        return ",".join(map(self.decimal.__getitem__, ids)).encode()

    def _pieces(self, text: str) -> Iterator[list[str]]:
        """The pieces of a text; of a long one so many at a time."""
        if len(text) <= LONG_TEXT:
            yield self.split.findall(text)
            return
        found = (m.group() for m in self.split.finditer(text))
        while some := list(islice(found, PIECES)):
            yield some

    def encode(self, text: str) -> list[int]:
        self.memo.turn()
        ids: list[int] = []
        for pieces in self._pieces(text):
            for part in map(self.memo.__getitem__, pieces):
                ids.extend(map(int, part.split(b",")))
        return ids

    def decode(self, ids: list[int] | tuple[int, ...]) -> bytes:
        return b"".join(map(self.token_bytes.__getitem__, ids))

    def digests(self, text: str) -> tuple[int, str, str]:
        """The number of tokens, and the SHA-256 of their ids in decimals and of the decoded bytes.

        Every piece's ids are decoded when it is first met, and must give the piece; so
        the bytes that a text decodes to are put together from its pieces.
        """
        self.memo.turn()
        n, ids, decoded = 0, hashlib.sha256(), hashlib.sha256()
        for pieces in self._pieces(text):
            if pieces:
                part = b",".join(map(self.memo.__getitem__, pieces))
                ids.update(b"," + part if n else part)
                decoded.update("".join(pieces).encode())
                n += part.count(b",") + 1
        return n, ids.hexdigest(), decoded.hexdigest()


class _Memo(dict):
    """What a piece is encoded to, in two generations: what is in use survives a full memo.

    Long ones pass through unkept.
    """

    def __init__(self, encode: Callable[[str], bytes], entries: int):
        super().__init__()
        self.encode_piece, self.entries = encode, entries
        self.older: dict[str, bytes] = {}

    def __missing__(self, piece: str) -> bytes:
        ids = self.older.get(piece)
        if ids is None:
            ids = self.encode_piece(piece)
        if len(piece) <= MEMO_PIECE:
            self[piece] = ids
        return ids

    def turn(self) -> None:
        if len(self) > self.entries:
            self.older = dict(self)
            self.clear()


_CODECS: dict[str, BytePairCodec] = {}


def codec_for(rank_file: bytes, pattern: str) -> BytePairCodec:
    """One codec for each vocabulary in a Python worker, which serves many tasks."""
    key = hashlib.sha256(rank_file + pattern.encode()).hexdigest()
    if key not in _CODECS:
        _CODECS[key] = BytePairCodec(rank_file, pattern)
    return _CODECS[key]


def read_vocabulary(path: str) -> bytes:
    with open(path, "rb") as f:
        data = f.read(MAX_VOCABULARY_BYTES + 1)
    if len(data) > MAX_VOCABULARY_BYTES:
        raise ValueError(f"{path} has more than {MAX_VOCABULARY_BYTES} bytes")
    return data


def bpe_encode(
    docs: DataFrame,
    vocabulary_path: str,
    pattern: str,
    keep_ids: bool = False,
) -> DataFrame:
    """Encode every whole text and decode the ids again.

    Returns doc_id, n_tokens, ids_sha256, decoded_sha256; with ``keep_ids`` also
    ids (array<int>) and decoded (binary).  One row per row of ``docs``.  Other
    columns of ``docs`` are not read.  A long text may come to any length: ids are
    built row by row, and a batch is sent on as soon as it holds 16 MB of text.
    """
    spark = docs.sparkSession
    small_batches(spark)
    vocabulary = spark.sparkContext.broadcast(read_vocabulary(vocabulary_path))
    fields = [("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())]
    sql = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    if keep_ids:
        fields += [("ids", pa.list_(pa.int32())), ("decoded", pa.binary())]
        sql += ", ids array<int>, decoded binary"
    schema = pa.schema(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_for(vocabulary.value, pattern)
        for batch in batches:
            out: dict[str, list] = {f.name: [] for f in schema}
            out["doc_id"] = batch.column(0).to_pylist()
            for raw in batch.column(1):
                text = raw.as_py().decode("utf-8", "replace")
                for name, value in zip(("n_tokens", "ids_sha256", "decoded_sha256"), codec.digests(text), strict=True):
                    out[name].append(value)
                if keep_ids:
                    out["ids"].append(codec.encode(text))
                    out["decoded"].append(codec.decode(out["ids"][-1]))
            yield record_batch(out, schema)

    chosen = docs.select(docs["doc_id"].cast("long").alias("doc_id"), utf8(docs["text"]).alias("text"))
    return chosen.mapInArrow(run, sql)
