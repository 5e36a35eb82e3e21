"""Benchmark decontamination (operator 1).

Every window of ten consecutive words of a benchmark item (the whole item where
it has fewer) is a pattern of one Aho-Corasick automaton.  Each document is
normalised to lower-case words between single blanks and scanned once; matches
come as offsets in the normalised text and are mapped to words, and on request
to byte spans of the original text.

The automaton has a bounded size.  Where the windows of a large benchmark would exceed
it, only those that occur in the documents at all go in: their hashes are first looked
up, as one sorted array of eight bytes a window, among the rolling hashes of the
documents' words.  Only what is still too much is cut into blocks, with an automaton
and a scan of the documents for each.

Null text has no words.  A benchmark row without words gives no window; a null
item_id is listed as ``null``.  Repeated item rows count as one item.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import LOWER, UPPER, WORD_TABLE, alnum_words, cut, record_batch, small_batches, utf8

WINDOW = 10
#: Characters of patterns in one automaton (about 60 bytes of memory for each).
BLOCK_CHARS = 1 << 21
#: Hashes of windows that are looked up at a time (8 bytes each).
HASHES = 1 << 22
NOT_WORD = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def item_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Distinct windows of all items: pattern, items (sorted ids as strings)."""
    words = F.filter(F.split(F.translate(benchmark["text"].cast("string"), UPPER, LOWER), NOT_WORD), lambda w: w != "")
    listed = benchmark.select(
        F.coalesce(benchmark["item_id"].cast("string"), F.lit("null")).alias("item"), words.alias("ws")
    ).filter(F.size("ws") > 0)
    starts = F.sequence(F.lit(0), F.greatest(F.size("ws") - window, F.lit(0)))
    pattern = F.array_join(F.slice("ws", F.col("start") + 1, window), " ")
    return (
        listed.select("item", "ws", F.explode(starts).alias("start"))
        .groupBy(pattern.alias("pattern"))
        .agg(F.sort_array(F.collect_set("item")).alias("items"))
    )


def _size(windows: DataFrame) -> int:
    return windows.agg(F.sum(F.length("pattern") + F.length(F.array_join("items", ",")))).first()[0] or 0


def _blocks(windows: DataFrame, docs: DataFrame, text: str) -> tuple[int, DataFrame]:
    """How many blocks the windows make, and the windows with their block."""
    windows = cut(windows, "windows")
    chars = _size(windows)
    if chars > BLOCK_CHARS:
        windows = cut(occurring(windows, docs, text), "occurring")
        chars = _size(windows)
    n = max(1, -(-2 * chars // BLOCK_CHARS)) if chars > BLOCK_CHARS else 1
    return n, windows.withColumn("block", F.pmod(F.xxhash64("pattern"), F.lit(n)))


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return values ^ (values >> np.uint64(29))


def window_hashes(words: list[bytes], size: int) -> np.ndarray:
    """A hash of each run of ``size`` words."""
    n = len(words) - size + 1
    if n < 1:
        return np.zeros(0, dtype=np.uint64)
    own = np.fromiter(map(xxhash.xxh64_intdigest, words), dtype=np.uint64, count=len(words))
    out = np.full(n, size, dtype=np.uint64)
    for i in range(size):
        out = out * np.uint64(0x9E3779B97F4A7C15) + own[i : i + n]
    return _mixed(out)


def occurring(windows: DataFrame, docs: DataFrame, text: str) -> DataFrame:
    """The windows that may occur in a text of ``docs``: all that do, and by chance others.

    Hashes go to the executors in sorted arrays of at most HASHES; of the documents only
    the hashes that are found come back, once a task each.
    """
    spark = docs.sparkSession

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [p.split(" ") for p in batch.column(0).to_pylist()]
            values = [int(window_hashes([w.encode() for w in ws], len(ws))[0]) for ws in words]
            arrays = [batch.column(0), batch.column(1), pa.array(np.array(values, dtype=np.uint64).view(np.int64)), pa.array([len(ws) for ws in words], type=pa.int32())]
            yield pa.RecordBatch.from_arrays(arrays, names=["pattern", "items", "hash", "size"])

    marked = cut(windows.select("pattern", "items").mapInArrow(hashed, "pattern string, items array<string>, hash long, size int"), "hashed")
    sizes = [r[0] for r in marked.select("size").distinct().collect()]
    n = max(1, -(-marked.count() // HASHES))
    raw = docs.select(utf8(docs[f"`{text}`"]).alias("raw"))
    found = None
    for part in range(n):
        rows = marked.filter(F.pmod("hash", F.lit(n)) == part).select("hash").distinct().toArrow()
        sent = spark.sparkContext.broadcast(np.sort(rows.column("hash").to_numpy()))

        def look(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:  # noqa: ANN001
            known = sent.value
            seen = np.zeros(len(known), dtype=bool)
            for batch in batches:
                for text_ in batch.column(0):
                    words = alnum_words(text_.as_py())
                    for size in sizes:
                        own = window_hashes(words, size).view(np.int64)
                        at = np.minimum(np.searchsorted(known, own), len(known) - 1)
                        seen[at[known[at] == own]] = True
            yield pa.RecordBatch.from_arrays([pa.array(known[seen])], names=["hash"])

        if len(sent.value):
            got = raw.mapInArrow(look, "hash long").distinct()
            found = got if found is None else found.unionByName(got)
    return windows.limit(0) if found is None else marked.join(found, "hash", "left_semi").select("pattern", "items")


class Scanner:
    """One block of windows as an automaton over blank-separated Latin-1 text."""

    def __init__(self, windows: list[tuple[str, list[str]]]):
        self.automaton = ahocorasick.Automaton()
        self.windows = windows
        for i, (pattern, _) in enumerate(windows):
            key = f" {pattern} ".encode().decode("latin-1")
            self.automaton.add_word(key, (i, len(key)))
        if windows:
            self.automaton.make_automaton()

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Merged runs [first, last] of words that are hit, and the items that hit."""
        if not words or not self.windows:
            return [], set()
        text = (b" " + b" ".join(words) + b" ").decode("latin-1")
        found = list(self.automaton.iter(text))
        if not found:
            return [], set()
        starts, at = [], 1
        for w in words:
            starts.append(at)
            at += len(w) + 1
        items: set[str] = set()
        runs: list[list[int]] = []
        spans = sorted((end + 2 - size, end - 1, i) for end, (i, size) in found)
        for first, last, i in spans:
            items.update(self.windows[i][1])
            a, b = bisect_right(starts, first) - 1, bisect_right(starts, last) - 1
            if runs and a <= runs[-1][1] + 1:
                runs[-1][1] = max(runs[-1][1], b)
            else:
                runs.append([a, b])
        return [(a, b) for a, b in runs], items


def _join_runs(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(runs):
        if out and a <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def original_spans(text: bytes, runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Byte offsets [from, to) in the original text of runs of words."""
    spaced = text.translate(WORD_TABLE)
    out, want, at, index = [], iter(runs), 0, 0
    run = next(want, None)
    start = 0
    for word in spaced.split():
        if run is None:
            break
        at = spaced.index(word, at)
        if index == run[0]:
            start = at
        at += len(word)
        if index == run[1]:
            out.append((start, at))
            run = next(want, None)
        index += 1
    return out


_SCANNERS: dict[str, Scanner] = {}


def _scanner(key: str, windows: list[tuple[str, list[str]]]) -> Scanner:
    if key not in _SCANNERS:
        _SCANNERS.clear()
        _SCANNERS[key] = Scanner(windows)
    return _SCANNERS[key]


HIT_SQL = "struct<n_words:long,runs:array<struct<first:int,last:int>>,items:array<string>>"
_RUNS = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))
_HIT_FIELDS = [("n_words", pa.int64()), ("runs", _RUNS), ("items", pa.list_(pa.string()))]


def scan(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    window: int = WINDOW,
    keep_text: bool = True,
) -> DataFrame:
    """row, hit: a struct of the columns of ``docs``, and one of n_words, runs of hit words, items.

    All columns of ``docs`` are kept (the text only with ``keep_text``) and travel by
    place, so their names do no harm.
    """
    small_batches(docs.sparkSession)
    kept = [c for c in docs.columns if keep_text or c != text]
    names = [f"c{i}" for i in range(len(kept))]
    plain: list[Column] = [docs[f"`{c}`"].alias(a) for c, a in zip(kept, names, strict=True)]
    out = docs.select(*plain, utf8(docs[f"`{text}`"]).alias("raw"), F.lit(None).cast(HIT_SQL).alias("hit"))
    n, windows = _blocks(item_windows(benchmark, window), docs, text)
    for block in range(n):
        rows = windows.filter(F.col("block") == block).select("pattern", "items").collect()
        listed = sorted((r["pattern"], list(r["items"])) for r in rows)
        out = _scan_block(out, listed, block < n - 1)
        if n > 1:
            out = cut(out, "scan")
    row = F.struct(*[F.col(a).alias(c) for a, c in zip(names, kept, strict=True)])
    return out.select(row.alias("row"), "hit")


def _scan_block(given: DataFrame, windows: list[tuple[str, list[str]]], keep_raw: bool) -> DataFrame:
    """``given`` (columns by place, raw, hit) with the hits of these windows added."""
    sent = given.sparkSession.sparkContext.broadcast(windows)
    key = hashlib.sha256(repr(windows).encode()).hexdigest()
    hit_type = pa.struct(_HIT_FIELDS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = _scanner(key, sent.value)
        for batch in batches:
            hits = []
            raw_at, hit_at = batch.num_columns - 2, batch.num_columns - 1
            for raw, earlier in zip(batch.column(raw_at), batch.column(hit_at), strict=True):
                words = alnum_words(raw.as_py())
                runs, items = scanner.scan(words)
                if earlier.is_valid and (old := earlier.as_py()):
                    runs = _join_runs(runs + [(r["first"], r["last"]) for r in old["runs"]])
                    items |= set(old["items"])
                hits.append({"n_words": len(words), "runs": [{"first": a, "last": b} for a, b in runs], "items": sorted(items)})
            columns = [batch.column(i) for i in range(hit_at if keep_raw else raw_at)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(hits, type=hit_type)], names=schema.names)

    schema = (given if keep_raw else given.drop("raw")).schema
    return given.mapInArrow(run, schema)


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated, runs: a row per document.

    ``runs`` lists the first and last word (from 0) of each run of hit words;
    ``original_spans`` maps them to byte offsets of the original text.
    """
    chosen = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
    scanned = scan(chosen, benchmark, "text", window, keep_text=False)
    hit_words = F.aggregate("hit.runs", F.lit(0).cast("long"), lambda a, r: a + r["last"] - r["first"] + 1)
    return scanned.select(
        F.col("row.doc_id").alias("doc_id"),
        F.col("hit.n_words").alias("n_words"),
        hit_words.alias("n_hit"),
        F.size("hit.items").cast("long").alias("n_items"),
        F.sha2(F.array_join("hit.items", ","), 256).alias("items_sha256"),
        (hit_words > 0).alias("contaminated"),
        F.col("hit.runs").alias("runs"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of ``docs``, all columns, without a word of any benchmark window."""
    scanned = scan(docs, benchmark, "text", window)
    return scanned.filter(F.size("hit.runs") == 0).select("row.*")
