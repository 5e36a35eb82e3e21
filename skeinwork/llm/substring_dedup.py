"""Substring dedup by sliding sentence spans (operator 4).

A text is cut into sentences: after ``.``, ``!`` or ``?`` (also before a closing
quote or bracket), at line breaks, and, where no sentence begins within ``NEAR``
words, at content-defined places: before the least word, in byte order, of every
window of ``WINDOW`` words.  Those places depend on the words around them only, so
a passage that stands in the middle of long or unpunctuated sentences is cut alike
wherever it occurs.

From every sentence on, the shortest run of at least two sentences and ``MIN_WORDS``
words is hashed to 96 bits.  Runs meet by hash over all documents.  The first
occurrence of a run, by doc_id and then by place, stays; the sentences that any
later occurrence covers are removed.  Words compare with A-Z lower-cased and
without the white space around them; what stays keeps its own text and spacing.

Words are what ASCII white space parts; ideographs, kana and Thai letters, which
are written without blanks, are words each.

Only (hash, document, place) rows travel; they are written once.  Counting has a
map-side part, and the join that hands the first occurrences back can be split
where a run is very frequent.

Null text stays null, with no sentences; texts without words stay as they are.  A
null doc_id stands among the negative ones, by a hash of its text.  Rows that agree
in doc_id and text are one document and get the same result, as often as they came;
rows of one doc_id with other texts are other documents, by a hash of the text.  A
document may end up with empty text.  An empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Tables, cut, small_batches, utf8

MIN_WORDS, WINDOW, NEAR = 40, 10, 5
#: UTF-8 of the letters that are words each: Thai, U+3000 to U+9FFF, compatibility ideographs.
UNSPACED = rb"\xe0[\xb8\xb9][\x80-\xbf]|[\xe3-\xe9][\x80-\xbf]{2}|\xef[\xa4-\xab][\x80-\xbf]"
ANY_UNSPACED = re.compile(UNSPACED)
WORD = re.compile(UNSPACED + rb"|(?:(?!" + UNSPACED + rb")[^ \t\n\x0b\x0c\r])+")


def _flags(of: bytes) -> np.ndarray:
    out = np.zeros(256, dtype=bool)
    out[list(of)] = True
    return out


SPACE, ENDS, CLOSERS = _flags(b" \t\n\x0b\x0c\r"), _flags(b".!?"), _flags(b"\"')]")
#: Ideographic full stop, exclamation and question mark, which are words of their own.
UNSPACED_ENDS = {"。".encode(), "！".encode(), "？".encode()}
#: Odd bases of the rolling hashes.
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def _settled(df: DataFrame, name: str) -> DataFrame:
    """As ``cut``; the shuffle files behind the table go once it is written."""
    conf = df.sparkSession.conf
    before = conf.get(CLEANUP)
    conf.set(CLEANUP, "true")
    try:
        return cut(df, name)
    finally:
        conf.set(CLEANUP, before)


def words_of(raw: bytes) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """The words with A-Z lower-cased, and the places of their first bytes and ends."""
    if ANY_UNSPACED.search(raw):
        found = [m.span() for m in WORD.finditer(raw)]
        low = raw.lower()
        edges = np.array(found, dtype=np.int64).reshape(-1, 2)
        return [low[a:b] for a, b in found], edges[:, 0], edges[:, 1]
    blank = np.ones(len(raw) + 2, dtype=bool)
    blank[1:-1] = SPACE[np.frombuffer(raw, dtype=np.uint8)]
    turns = np.flatnonzero(blank[1:] != blank[:-1])
    return raw.lower().split(), turns[::2], turns[1::2]


def _least_places(ranks: np.ndarray, window: int) -> np.ndarray:
    """Places of the (first) least rank of every window."""
    n = len(ranks)
    if n < window:
        return np.zeros(0, dtype=np.int64)
    least, width = ranks * n + np.arange(n), 1
    while width < window:
        step = min(width, window - width)
        least = np.minimum(least[:-step], least[step:])
        width += step
    return np.unique(least % n)


def sentence_starts(raw: bytes, words: list[bytes], begins: np.ndarray, ends: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """Places of the sentences' first words, and last the number of words."""
    n = len(words)
    if not n:
        return np.zeros(1, dtype=np.int64)
    data = np.frombuffer(raw, dtype=np.uint8)
    last, before = data[ends - 1], data[np.maximum(ends - 2, begins)]
    closed = ENDS[last] | (CLOSERS[last] & ENDS[before])
    if not raw.isascii():
        closed |= np.fromiter((w in UNSPACED_ENDS for w in words), dtype=bool, count=n)
    first = np.zeros(n + 1, dtype=bool)
    first[0] = True
    first[1:] |= closed
    first[np.searchsorted(begins, np.flatnonzero(data == 10))] = True
    first = first[:n]
    places = _least_places(ranks, WINDOW)
    counted = np.zeros(n + 1, dtype=np.int64)
    np.cumsum(first, out=counted[1:])
    near = counted[np.minimum(places + NEAR + 1, n)] - counted[np.maximum(places - NEAR, 0)]
    first[places[near == 0]] = True
    return np.append(np.flatnonzero(first), n)


class Powers:
    """Powers of the bases and of their inverses, as many as were asked for so far."""

    def __init__(self):
        self.up = [np.ones(1, dtype=np.uint64)] * len(BASES)
        self.down = list(self.up)

    def reach(self, n: int) -> None:
        if len(self.up[0]) < n:
            for i, base in enumerate(BASES):
                for side, factor in ((self.up, base), (self.down, pow(base, -1, 1 << 64))):
                    steps = np.full(n + n // 2, factor, dtype=np.uint64)
                    steps[0] = 1
                    side[i] = np.cumprod(steps, dtype=np.uint64)


POWERS = Powers()


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def run_ends(starts: np.ndarray, min_words: int) -> np.ndarray:
    """For each sentence the sentence after the run that begins there; some beyond the last."""
    n = len(starts) - 1
    return np.maximum(np.arange(n) + 2, np.searchsorted(starts, starts[:-1] + min_words))


def text_runs(raw: bytes, min_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Two hashes of each run of a text, and its first sentence."""
    words, begins, ends = words_of(raw)
    n = len(words)
    if n < min_words:
        nothing = np.zeros(0, dtype=np.uint64)
        return nothing, nothing, nothing.astype(np.int64)
    different = sorted(set(words))
    rank = {w: i for i, w in enumerate(different)}
    ranks = np.fromiter(map(rank.__getitem__, words), dtype=np.int64, count=n)
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, different), dtype=np.uint64, count=len(different))[ranks]
    starts = sentence_starts(raw, words, begins, ends, ranks)
    after = run_ends(starts, min_words)
    at = np.flatnonzero(after < len(starts))
    first, last = starts[at], starts[after[at]]
    POWERS.reach(n)
    sums = np.zeros(n + 1, dtype=np.uint64)
    out = []
    for up, down in zip(POWERS.up, POWERS.down, strict=True):
        np.cumsum(hashes * up[:n], dtype=np.uint64, out=sums[1:])
        out.append(_mixed((sums[last] - sums[first]) * down[first]))
    return out[0], out[1], at


def without(raw: bytes, at: list[int], min_words: int) -> tuple[bytes, int]:
    """The text without the sentences of the runs that begin ``at``; their number."""
    words, begins, ends = words_of(raw)
    rank = {w: i for i, w in enumerate(sorted(set(words)))}
    ranks = np.fromiter(map(rank.__getitem__, words), dtype=np.int64, count=len(words))
    starts = sentence_starts(raw, words, begins, ends, ranks)
    n = len(starts) - 1
    edge = np.zeros(n + 1, dtype=np.int64)
    first = np.unique(at)
    np.add.at(edge, first, 1)
    np.add.at(edge, run_ends(starts, min_words)[first], -1)
    gone = np.cumsum(edge[:n]) > 0
    offsets = np.append(begins[starts[:-1]], len(raw))
    offsets[0] = 0
    turns = np.flatnonzero(np.diff(np.concatenate([[True], gone, [True]])))
    kept = [raw[offsets[a] : offsets[b]] for a, b in zip(turns[::2].tolist(), turns[1::2].tolist(), strict=True)]
    return b"".join(kept), int(gone.sum())


def _joined(run, schema: pa.Schema, rows: int = 50_000):  # noqa: ANN001, ANN202
    """The batches of ``run`` in larger ones."""

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in run(batches):
            held.append(batch)
            if sum(b.num_rows for b in held) > rows:
                yield from pa.Table.from_batches(held, schema).combine_chunks().to_batches()
                held = []
        if held:
            yield from pa.Table.from_batches(held, schema).combine_chunks().to_batches()

    return joined


def _document(docs: DataFrame) -> list[Column]:
    """doc and mark, which tell documents apart: doc_id and a hash of the text."""
    mark = F.xxhash64(docs["text"].cast("string"))
    return [
        F.coalesce(docs["doc_id"].cast("long"), mark.bitwiseOR(F.lit(-(1 << 63)))).alias("doc"),
        mark.alias("mark"),
    ]


def run_places(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """h1, h2, doc, mark, place: every run of every text."""
    small_batches(docs.sparkSession)
    schema = pa.schema([("h1", pa.int64()), ("h2", pa.int32()), ("doc", pa.int64()), ("mark", pa.int64()), ("place", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, marks = (batch.column(i).to_pylist() for i in (0, 1))
            parts = [text_runs(raw.as_py(), min_words) for raw in batch.column(2)]
            sizes = [len(p[2]) for p in parts]
            h1, h2, at = (np.concatenate([p[i] for p in parts]) if parts else np.zeros(0, dtype=np.uint64) for i in range(3))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(h1.view(np.int64)),
                    pa.array((h2 >> np.uint64(32)).astype(np.uint32).view(np.int32)),
                    pa.array(np.repeat(np.array(ids, dtype=np.int64), sizes)),
                    pa.array(np.repeat(np.array(marks, dtype=np.int64), sizes)),
                    pa.array(at.astype(np.int32)),
                ],
                schema=schema,
            )

    given = docs.select(*_document(docs), utf8(docs["text"]).alias("raw"))
    return given.mapInArrow(_joined(run, schema), "h1 long, h2 int, doc long, mark long, place int")


def later_runs(runs: DataFrame) -> DataFrame:
    """doc, mark, place of all but the first occurrence of each (h1, h2)."""
    found = runs.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n"), F.min("doc").alias("first_doc"))
    # Both sides of the joins come from tables, so that a very frequent run can be split.
    repeats = _settled(found.filter("n > 1").drop("n"), "repeats")
    met = _settled(runs.join(repeats, ["h1", "h2"]), "repeated-runs")
    own = met.filter("doc = first_doc")
    firsts = _settled(own.groupBy("h1", "h2").agg(F.min(F.struct("mark", "place")).alias("first")), "firsts")
    again = own.join(firsts, ["h1", "h2"]).filter(F.struct("mark", "place") > F.col("first"))
    return met.filter("doc > first_doc").select("doc", "mark", "place").unionByName(again.select("doc", "mark", "place"))


def repeated_spans(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """doc, mark, starts: first sentences of the runs to remove, by document."""
    with Tables() as tables:
        runs = _settled(run_places(docs, min_words), "runs")
        spans = later_runs(runs).groupBy("doc", "mark").agg(F.collect_set("place").alias("starts"))
        out = _settled(spans, "spans")
        tables.drop(docs.sparkSession, keep="spans")
    return out


def remove_repeated_spans(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """row (a struct of all columns of ``docs``, with the cleaned text), n_removed.

    A row per row of ``docs``; columns travel by place, so their names do no harm.
    """
    spans = repeated_spans(docs, min_words)
    names = [f"c{i}" for i in range(len(docs.columns))]
    text_at = docs.columns.index("text")
    plain = [docs[f"`{c}`"] if c != "text" else docs["text"].cast("string") for c in docs.columns]
    given = docs.select(*[x.alias(a) for x, a in zip(plain, names, strict=True)], F.struct(*_document(docs)).alias("key"))
    met = given.join(spans.select(F.struct("doc", "mark").alias("key"), "starts"), "key", "left").select(*names, "starts")
    made = T.StructType([*met.schema.fields[:-1], T.StructField("n_removed", T.LongType())])

    def rebuild(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, removed = batch.column(text_at).to_pylist(), []
            for i, at in enumerate(batch.column(len(names)).to_pylist()):
                lost = 0
                if at:
                    left, lost = without(texts[i].encode(), at, min_words)
                    texts[i] = left.decode()
                removed.append(lost)
            columns = [batch.column(i) for i in range(len(names))]
            columns[text_at] = pa.array(texts, type=batch.schema.field(text_at).type)
            yield pa.RecordBatch.from_arrays([*columns, pa.array(removed, type=pa.int64())], names=made.names)

    done = met.mapInArrow(rebuild, made)
    row = F.struct(*[F.col(a).alias(c) for a, c in zip(names, docs.columns, strict=True)])
    return done.select(row.alias("row"), "n_removed")


def substring_dedup(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """doc_id, n_removed (sentences), text: a row per row of ``docs``."""
    chosen = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
    return remove_repeated_spans(chosen, min_words).select("row.doc_id", "n_removed", "row.text")
