"""Quality rules with distribution divergence (operator 3).

Base rules count symbols, repeated lines and repeated eight-word windows.  The
method compares two histograms of a document with those of its language: shares
of character classes, and shares of the language's common words against all
other words.  A document is rejected where a Jensen-Shannon distance (the root of
the divergence to base 2, from 0 to 1) exceeds its limit.  Short documents have
ragged histograms, so each comparison has a length below which it is not made.

The references are the corpus' own.  A language's common words are those that the
largest shares of all its documents hold, counted over the whole table.  Its shares
are the means over all its documents that are long enough to be judged, each weighing
the same, so neither one long document nor junk of great length bends them.  Both
are kept in a table by language, which meets the documents in a join, however many
languages there are.  Documents without a language, or of one with fewer than
``REFERENCE_MIN_DOCS`` judged documents, are held against the references of the
``WIDESPREAD`` largest languages, of which the nearest counts.  Where no language has
a reference, as in a table without languages, character classes are held against the
mean of all documents, and common words, which differ by language, are not judged.

Null text: no words; base_failed is true as n_words is below 20.  Repeated rows
are judged each for itself.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, record_batch, small_batches, utf8

WINDOW, MIN_WORDS, REPEATED_PERCENT = 8, 20, 30
#: Limits of the distances and the sizes from which they are judged.
CHAR_LIMIT, CHAR_MIN = 0.34, 200
WORD_LIMIT, WORD_MIN = 0.40, 100
#: Fewer judged documents of a language make no reference of their own.
REFERENCE_MIN_DOCS = 20
#: Common words: so many at most for each language, each in this share of its documents.
COMMON_WORDS, COMMON_SHARE = 64, 0.1
#: Languages whose references stand for those that have none.
WIDESPREAD = 20
#: Distinct words that a task counts before it passes them on.
TASK_WORDS = 300_000

SPACE = b" \t\n\r\x0b\x0c"
SYMBOLS = b"#*$%&|<>"
CONTINUATION = bytes(range(0x80, 0xC0))

MARKS = b".,;:!?'\"()-"

#: Of ASCII by use, and beyond it by script, as the first byte of a code point tells.
CLASSES = (
    "lower", "upper", "digit", "space", "newline", "point", "mark", "symbol",
    "latin", "greek", "cyrillic", "hebrew", "arabic", "indic", "various", "sign", "ideograph", "hangul", "private", "beyond",
)
#: The first byte from which each of the scripts holds.
SCRIPTS = (0xC0, 0xCC, 0xD0, 0xD5, 0xD8, 0xE0, 0xE1, 0xE2, 0xE3, 0xEA, 0xEE, 0xF0)


def _class_of(b: int) -> int:
    c = chr(b)
    if b >= 0xC0:
        return CLASSES.index("latin") + sum(b >= at for at in SCRIPTS) - 1
    if b >= 0x80:
        return -1
    if c.islower():
        return 0
    if c.isupper():
        return 1
    if c.isdigit():
        return 2
    if c == "\n":
        return 4
    if c in " \t\r\x0b\x0c":
        return 3
    if b in MARKS:
        return 5
    if c in "#*$%&|<>":
        return 7
    return 6


BYTE_CLASS = np.array([_class_of(b) for b in range(256)])
CLASS_MATRIX = np.array([[BYTE_CLASS[b] == k for k in range(len(CLASSES))] for b in range(256)], dtype=np.float64)


def char_histogram(text: bytes) -> np.ndarray:
    """Code points by class; a code point beyond ASCII is counted at its first byte."""
    return np.bincount(np.frombuffer(text, np.uint8), minlength=256) @ CLASS_MATRIX


def bare(word: bytes) -> bytes:
    return word.strip(MARKS)


def word_histogram(lowered: list[bytes], places: dict[bytes, int]) -> np.ndarray:
    """Counts of the common words, and last of all others; marks at the ends are cut off."""
    out = np.zeros(len(places) + 1)
    for word, n in Counter(lowered).items():
        out[places.get(bare(word), -1)] += n
    return out


def shares(histogram: np.ndarray) -> np.ndarray:
    total = histogram.sum()
    return histogram / total if total else histogram


def jensen_shannon(p: np.ndarray, q: np.ndarray) -> float:
    m = (p + q) / 2

    def relative(x: np.ndarray) -> float:
        on = x > 0
        return float((x[on] * np.log2(x[on] / m[on])).sum())

    return max(0.0, (relative(p) + relative(q)) / 2) ** 0.5


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words within windows that occur at least twice."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    # Rolling sums of the words' hashes find the windows to look at; equal sums are
    # then told apart by the words themselves.
    hashes = np.fromiter(map(hash, words), dtype=np.int64, count=len(words)).view(np.uint64)
    sums = np.zeros(n, dtype=np.uint64)
    factor = 1
    for k in range(window):
        sums += hashes[k : k + n] * np.uint64(factor)
        factor = factor * 0x9E3779B97F4A7C15 % (1 << 64)
    order = np.argsort(sums, kind="stable")
    same = sums[order][1:] == sums[order][:-1]
    if not same.any():
        return 0
    suspect = np.zeros(n, dtype=bool)
    suspect[order[1:][same]] = True
    suspect[order[:-1][same]] = True
    places: dict[tuple[bytes, ...], int] = {}
    twice = np.zeros(len(words) + 1, dtype=np.int64)
    for i in np.nonzero(suspect)[0].tolist():
        key = tuple(words[i : i + window])
        first = places.setdefault(key, i)
        if first != i:
            for at in (first, i) if first >= 0 else (i,):
                twice[at] += 1
                twice[min(at + window, len(words))] -= 1
            places[key] = -1
    return int((np.cumsum(twice[:-1]) > 0).sum())


def base_counts(text: bytes, words: list[bytes]) -> dict[str, int]:
    """The five counts of the base rules."""
    seen: set[bytes] = set()
    repeated = 0
    for line in text.split(b"\n"):
        if line in seen:
            repeated += 1
        elif line.strip(SPACE):
            seen.add(line)
    return {
        "n_words": len(words),
        "word_chars": len(text.translate(None, SPACE + CONTINUATION)),
        "n_symbols": len(text) - len(text.translate(None, SYMBOLS)),
        "n_dup_lines": repeated,
        "n_repeat_words": repeated_words(words),
    }


def fails_base(counts: dict[str, int]) -> bool:
    return counts["n_words"] < MIN_WORDS or 100 * counts["n_repeat_words"] > REPEATED_PERCENT * counts["n_words"]


def _texts(docs: DataFrame, *columns: Column) -> DataFrame:
    return docs.select(*columns, utf8(docs["text"]).alias("raw"), docs["lang"].cast("string").alias("lang"))


def common_words(docs: DataFrame) -> DataFrame:
    """lang, n_docs, words: the common words of each language, in order of their shares."""
    small_batches(docs.sparkSession)
    schema = pa.schema([("lang", pa.string()), ("word", pa.binary()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, Counter] = {}

        def flush() -> Iterator[pa.RecordBatch]:
            for lang, words in counts.items():
                keys = list(words)
                for i in range(0, len(keys), 50_000):
                    part = keys[i : i + 50_000]
                    yield record_batch({"lang": [lang] * len(part), "word": part, "n": [words[w] for w in part]}, schema)
            counts.clear()

        for batch in batches:
            for raw, lang in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                # The empty word counts the documents.
                counts.setdefault(lang, Counter()).update({*map(bare, raw.as_py().lower().split()), b""})
            if sum(map(len, counts.values())) > TASK_WORDS:
                yield from flush()
        yield from flush()

    found = _texts(docs).filter("lang is not null").mapInArrow(run, "lang string, word binary, n long")
    counted = cut(found.groupBy("lang", "word").agg(F.sum("n").alias("n")), "words")
    # A table of its own, whose size is known: where it is small, no words are moved to meet it.
    totals = cut(counted.filter(F.octet_length("word") == 0).select("lang", F.col("n").alias("n_docs")), "languages")
    shared = counted.filter(F.octet_length("word") > 0).join(totals, "lang").filter(F.col("n") >= COMMON_SHARE * F.col("n_docs"))
    # A document's different words over COMMON_SHARE: so few rows of a language are left.
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "word")
    top = shared.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= COMMON_WORDS)
    listed = top.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("place", "word"))).alias("words"))
    words = F.coalesce(F.transform("words", lambda x: x["word"]), F.array().cast("array<binary>"))
    return totals.join(listed, "lang", "left").select("lang", "n_docs", words.alias("words"))


class _Places(dict):
    """The places of a language's common words, made once a worker."""

    def of(self, lang: str | None, words: pa.Scalar) -> dict[bytes, int]:
        key = (lang, len(words)) if words.is_valid else None
        if key not in self:
            self[key] = {w: i for i, w in enumerate(words.as_py() or [])} if key else {}
        return self[key]


def references(docs: DataFrame) -> DataFrame:
    """lang, words, n, chars, shares: the common words, the number of judged documents and their mean shares."""
    listed = cut(common_words(docs), "common")
    schema = pa.schema([("lang", pa.string()), ("n", pa.int64()), ("chars", pa.list_(pa.float64())), ("shares", pa.list_(pa.float64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, list] = {}
        places = _Places()
        for batch in batches:
            for raw, lang, words in zip(batch.column(0), batch.column(1).to_pylist(), batch.column(2), strict=True):
                text = raw.as_py()
                lowered = text.lower().split()
                if len(text) < CHAR_MIN or len(lowered) < WORD_MIN:
                    continue
                own = [1, shares(char_histogram(text)), shares(word_histogram(lowered, places.of(lang, words)))]
                sums[lang] = [a + b for a, b in zip(sums[lang], own, strict=True)] if lang in sums else own
        out = {"lang": list(sums), "n": [x[0] for x in sums.values()]}
        yield record_batch(out | {c: [x[i].tolist() for x in sums.values()] for i, c in ((1, "chars"), (2, "shares"))}, schema)

    given = _texts(docs).join(listed.select("lang", "words"), "lang").select("raw", "lang", "words")
    parts = given.mapInArrow(run, "lang string, n long, chars array<double>, shares array<double>")
    # Summed by place, in whole billionths, so that the order of tasks changes nothing.
    both = parts.select("lang", "n", F.posexplode(F.concat("chars", "shares")).alias("place", "x"))
    whole = F.round(F.col("x") * 1e9).cast("decimal(38,0)")
    summed = both.groupBy("lang", "place").agg(F.sum("n").alias("n"), F.sum(whole).alias("s"))
    means = summed.groupBy("lang").agg(
        F.max("n").alias("n"), F.sort_array(F.collect_list(F.struct("place", (F.col("s").cast("double") / F.col("n") / 1e9).alias("x")))).alias("means")
    )
    mean = F.transform("means", lambda x: x["x"])
    made = means.filter(F.col("n") >= REFERENCE_MIN_DOCS).select(
        "lang", "n", F.slice(mean, 1, len(CLASSES)).alias("chars"), F.slice(mean, len(CLASSES) + 1, COMMON_WORDS + 1).alias("shares")
    )
    return cut(made.join(listed.select("lang", "words"), "lang"), "references")


def whole_reference(docs: DataFrame) -> list[float] | None:
    """Mean shares of character classes of all documents that are judged; None where they are too few."""
    schema = pa.schema([("n", pa.int64()), ("chars", pa.list_(pa.float64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = 0, np.zeros(len(CLASSES))
        for batch in batches:
            for raw in batch.column(0):
                text = raw.as_py()
                if len(text) >= CHAR_MIN and len(text.split()) >= WORD_MIN:
                    n, sums = n + 1, sums + shares(char_histogram(text))
        yield record_batch({"n": [n], "chars": [sums.tolist()]}, schema)

    parts = _texts(docs).select("raw").mapInArrow(run, "n long, chars array<double>")
    whole = [F.sum(F.round(F.col("chars")[i] * 1e9).cast("decimal(38,0)")).cast("double") for i in range(len(CLASSES))]
    n, *sums = parts.agg(F.sum("n"), *whole).first()
    return [s / n / 1e9 for s in sums] if n and n >= REFERENCE_MIN_DOCS else None


class Reference:
    """Without shares of words these are not judged."""

    def __init__(self, words: list[bytes], chars: list[float], word_shares: list[float] | None):
        self.places = {w: i for i, w in enumerate(words)}
        self.chars, self.shares = np.array(chars), None if word_shares is None else np.array(word_shares)


def distances(text: bytes, lowered: list[bytes], refs: list[Reference]) -> tuple[float | None, float | None]:
    """Least distances of character classes and of common words; None where not judged."""
    chars = words = None
    if refs and len(text) >= CHAR_MIN:
        own = shares(char_histogram(text))
        chars = min(jensen_shannon(own, r.chars) for r in refs)
    with_words = [r for r in refs if r.shares is not None]
    if with_words and len(text) >= CHAR_MIN and len(lowered) >= WORD_MIN:
        words = min(jensen_shannon(shares(word_histogram(lowered, r.places)), r.shares) for r in with_words)
    return chars, words


def quality_rules(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, the four counts, base_failed, kept, char_distance, word_distance.

    One row per row of ``docs``; columns used: doc_id, text, lang.
    """
    spark = docs.sparkSession
    known = references(docs)
    # At most WIDESPREAD rows of some hundred numbers.
    largest = known.orderBy(F.desc("n"), "lang").limit(WIDESPREAD).select("words", "chars", "shares").collect()
    listed = [([bytes(w) for w in r["words"]], list(r["chars"]), list(r["shares"])) for r in largest]
    if not listed and (whole := whole_reference(docs)):
        listed = [([], whole, None)]
    sent = spark.sparkContext.broadcast(listed)
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    schema = pa.schema(
        [("doc_id", pa.int64())]
        + [(n, pa.int64()) for n in names]
        + [("base_failed", pa.bool_()), ("kept", pa.bool_()), ("char_distance", pa.float64()), ("word_distance", pa.float64())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        widespread = [Reference(*x) for x in sent.value]
        own: dict[str, Reference] = {}
        for batch in batches:
            out: dict[str, list] = {f.name: [] for f in schema}
            out["doc_id"] = batch.column(0).to_pylist()
            for raw, lang, ref in zip(batch.column(1), batch.column(2).to_pylist(), batch.column(3), strict=True):
                text = raw.as_py()
                counts = base_counts(text, text.split())
                if ref.is_valid and lang not in own:
                    given = ref.as_py()
                    own[lang] = Reference(given["words"], given["chars"], given["shares"])
                chars, words = distances(text, text.lower().split(), [own[lang]] if ref.is_valid else widespread)
                failed = fails_base(counts)
                far = (chars or 0) > CHAR_LIMIT or (words or 0) > WORD_LIMIT
                for n in names:
                    out[n].append(counts[n])
                out["base_failed"].append(failed)
                out["kept"].append(not failed and not far)
                out["char_distance"].append(chars)
                out["word_distance"].append(words)
            yield record_batch(out, schema)

    refs = known.select("lang", F.struct("words", "chars", "shares").alias("ref"))
    chosen = _texts(docs, docs["doc_id"].cast("long").alias("doc_id")).join(refs, "lang", "left").select("doc_id", "raw", "lang", "ref")
    sql = "doc_id long, " + ", ".join(f"{n} long" for n in names)
    return chosen.mapInArrow(run, sql + ", base_failed boolean, kept boolean, char_distance double, word_distance double")
