"""Quality classifier by co-training (operator 8).

Two views of a document: its text (words, word beginnings and style) and its
metadata (source, language, length).  A logistic regression for each view is fitted
on a bounded sample of labelled documents.  Over some rounds each view labels those
of all unlabelled documents of the table that it is most sure of, and hands them to
the other view's training set.  Both views are then calibrated on labelled documents
held out of training, and a last regression on the two calibrated log odds gives the
score of every document of the table.

The text is read once for the labelled sample, which gives the features, and once
for all documents, whose features are written as a table of short lists.  Rounds and
scores read that table.  A round's best documents are found by task and then over
all, so only they come to the driver; fitting is a task of its own.

A document is good if its quality label is 1 and its toxic label is not; several
labels of one document count as the worst of them; labels with null ids, or null
in both columns, are left out.  Rows of one doc_id with several texts give one
example, that of the text with the least hash.

Bounds (documented parameters): LABELLED labelled documents by the lowest hash of
their doc_id, FEATURES text features, HANDED_OVER documents a view, label and round.
Documents with equal features are one example; of equally sure ones the least hash
of the features goes first.  All documents are scored.

Null text counts as empty, null or missing metadata as a value of its own.  Repeated
rows get equal scores.  Without labels of both kinds nothing can be learned: every
document scores 1 and is kept.  An empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut, in_task, record_batch, small_batches, utf8
from .quality_rules import CLASSES, char_histogram, repeated_words, shares

LABELLED = 8000
FEATURES = 1500
#: Documents of the sample that must have a feature.
LEAST_DOCS = 4
#: Chi squared that a feature must reach, far above what chance gives one of them.
LEAST_TOLD = 15.0
ROUNDS, HANDED_OVER, SURE = 3, 150, 0.97
#: Shares in which the surest documents of all tasks are found first.
SHARES = 64
META = 512
KEEP_FROM = 0.5
MARKS = b".,;:!?'\"()-"


def text_features(lowered: list[bytes]) -> set[bytes]:
    """Words (with a blank after them) and their beginnings of four and five bytes."""
    words = {w.strip(MARKS) for w in set(lowered)}
    return {w + b" " for w in words} | {w[:4] for w in words} | {w[:5] for w in words}


STYLE = len(CLASSES) + 9


def style_features(text: bytes, lowered: list[bytes]) -> list[float]:
    """Shares of character classes and measures of repetition; STYLE numbers."""
    n = len(lowered)
    chars = shares(char_histogram(text)).tolist()
    lines = [x for x in text.split(b"\n") if x.strip()]
    repeats = repeated_words(lowered) / n if n else 0.0
    return [
        *chars,
        np.log1p(n),
        len(set(lowered)) / n if n else 1.0,
        len(text) / n / 10 if n else 0.0,
        repeats,
        1 - len(set(lines)) / len(lines) if lines else 0.0,
        float(n < 20),
        float(repeats > 0.3),
        min(chars[7] * 20, 1.0),
        min(chars[1] * 4, 1.0),
    ]


def meta_features(source: str | None, lang: str | None, n_chars: int | None) -> list[int]:
    """Hashed places of the metadata's values and of their pairs."""
    size = "none" if n_chars is None else str(int(np.log2(max(n_chars, 0) + 1)))
    keys = (f"s={source}", f"l={lang}", f"n={size}", f"l={lang},n={size}", f"s={source},l={lang}")
    return [zlib.crc32(k.encode()) % META for k in keys]


class Logistic:
    """L2-regularised logistic regression, fitted by Adam over the whole sample."""

    def __init__(self, penalty: float = 1e-4, steps: int = 250, rate: float = 0.1):
        self.penalty, self.steps, self.rate = penalty, steps, rate

    def fit(self, x: np.ndarray, y: np.ndarray) -> Logistic:
        w, b = np.zeros(x.shape[1], dtype=np.float32), 0.0
        m, v = np.zeros(x.shape[1] + 1), np.zeros(x.shape[1] + 1)
        # Both kinds weigh the same.
        weight = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum())).astype(np.float32)
        for t in range(1, self.steps + 1):
            off = (_sigmoid(x @ w + b) - y).astype(np.float32) * weight
            g = np.append(off @ x + self.penalty * w, off.sum())
            m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
            step = self.rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
            w, b = (w - step[:-1]).astype(np.float32), b - step[-1]
        self.w, self.b = w, float(b)
        return self

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        return x @ self.w + self.b


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _labels(labels: DataFrame) -> DataFrame:
    """doc_id, bad_quality, toxic (0 or 1 each): a row per labelled document."""
    worst = labels.select(
        labels["doc_id"].cast("long").alias("doc_id"), labels["quality"].alias("q"), labels["toxic"].alias("t")
    ).filter("doc_id is not null and (q is not null or t is not null)")
    return worst.groupBy("doc_id").agg(
        F.max((F.coalesce("q", F.lit(1)) != 1).cast("int")).alias("low"),
        F.max((F.coalesce("t", F.lit(0)) != 0).cast("int")).alias("toxic"),
    )


def _metadata(docs: DataFrame) -> list[Column]:
    """raw, source, lang, n_chars; what ``docs`` lacks is null."""
    kinds = {"source": "string", "lang": "string", "n_chars": "long"}
    given = [(docs[f"`{c}`"] if c in docs.columns else F.lit(None)).cast(kind).alias(c) for c, kind in kinds.items()]
    return [utf8(docs["text"]).alias("raw"), *given]


def _sample(docs: DataFrame, known: DataFrame) -> DataFrame:
    """doc_id, raw, source, lang, n_chars, low, toxic of the labelled sample, written once."""
    ids = docs.select(docs["doc_id"].cast("long").alias("doc_id")).filter("doc_id is not null")
    chosen = known.join(ids, "doc_id", "left_semi").orderBy(F.xxhash64("doc_id"), "doc_id").limit(LABELLED)
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), *_metadata(docs)).join(F.broadcast(chosen), "doc_id")
    one = F.min(F.struct(F.xxhash64("raw", "source", "lang", "n_chars"), "raw", "source", "lang", "n_chars", "low", "toxic"))
    return cut(rows.groupBy("doc_id").agg(one.alias("x")).select("doc_id", *[f"x.{c}" for c in ("raw", "source", "lang", "n_chars", "low", "toxic")]), "sample")


def _chosen_features(sampled: DataFrame) -> list[bytes]:
    """The features of the sample that tell most about either label."""
    schema = pa.schema([("feature", pa.binary())] + [(n, pa.int64()) for n in ("n", "low", "toxic")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = (Counter(), Counter(), Counter())
            columns = (batch.column(c) for c in ("raw", "low", "toxic"))
            for raw, low, toxic in zip(*columns, strict=True):
                found = text_features(raw.as_py().lower().split())
                for on, counter in zip((1, low.as_py(), toxic.as_py()), counts, strict=True):
                    if on:
                        counter.update(found)
            keys = list(counts[0])
            out = {"feature": keys} | {n: [c[k] for k in keys] for n, c in zip(("n", "low", "toxic"), counts, strict=True)}
            yield record_batch(out, schema)

    labelled = sampled.select("raw", "low", "toxic")
    total = labelled.agg(F.count(F.lit(1)), F.sum("low"), F.sum("toxic")).first()
    if not total[0]:
        return []
    counts = (
        labelled.mapInArrow(run, "feature binary, n long, low long, toxic long")
        .groupBy("feature")
        .agg(*[F.sum(c).alias(c) for c in ("n", "low", "toxic")])
        .filter(F.col("n") >= LEAST_DOCS)
    )
    chosen: list[bytes] = []
    for kind, with_label in (("low", total[1]), ("toxic", total[2])):
        # Chi squared of the two by two table of feature and label.
        a, n, all_, on = F.col(kind).cast("double"), F.col("n").cast("double"), float(total[0]), float(with_label)
        if not 0 < on < all_:
            continue
        off = a * all_ - n * on
        told = off * off * all_ / ((n * (all_ - n) + 1.0) * on * (all_ - on))
        strong = counts.withColumn("told", told).filter(F.col("told") >= LEAST_TOLD)
        rows = strong.orderBy(F.desc("told"), "feature").limit(FEATURES // 2).select("feature").collect()
        chosen += [bytes(r[0]) for r in rows]
    return list(dict.fromkeys(chosen))


class Example(NamedTuple):
    """Places of text features, style, places of metadata."""

    text: np.ndarray
    style: np.ndarray
    meta: np.ndarray


def _example(text: list[int], style: list[float], meta: list[int]) -> Example:
    return Example(np.array(text, dtype=np.int32), np.array(style, dtype=np.float32), np.array(meta, dtype=np.int32))


VECTOR_SQL = "text array<int>, style array<float>, meta array<int>, mark long"
_VECTOR = [("text", pa.list_(pa.int32())), ("style", pa.list_(pa.float32())), ("meta", pa.list_(pa.int32())), ("mark", pa.int64())]


def _featured(given: DataFrame, features: list[bytes]) -> DataFrame:
    """``given`` (any columns, last raw, source, lang, n_chars), with the vectors in place of these four."""
    sent = given.sparkSession.sparkContext.broadcast({f: i for i, f in enumerate(features)})
    schema = given.select(*given.columns[:-4]).schema
    n = len(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = sent.value
        for batch in batches:
            out: dict[str, list] = {f: [] for f, _ in _VECTOR}
            for raw, source, lang, n_chars in zip(*[batch.column(n + i).to_pylist() for i in range(4)], strict=True):
                lowered = raw.lower().split()
                text = sorted(place[f] for f in text_features(lowered) if f in place)
                style = np.array(style_features(raw, lowered), dtype=np.float32)
                meta = meta_features(source, lang, n_chars)
                mark = xxhash.xxh64_intdigest(np.array(text + meta, dtype=np.int32).tobytes() + style.tobytes()) >> 1
                for f, value in zip(out, (text, style, meta, mark), strict=True):
                    out[f].append(value)
            arrays = [pa.array(out[f], type=kind) for f, kind in _VECTOR]
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in range(n)], *arrays], names=[*schema.names, *out])

    ints, floats = T.ArrayType(T.IntegerType()), T.ArrayType(T.FloatType())
    more = [("text", ints), ("style", floats), ("meta", ints), ("mark", T.LongType())]
    return given.mapInArrow(run, T.StructType([*schema.fields, *[T.StructField(name, kind) for name, kind in more]]))


def _sums(weights: np.ndarray, lists: pa.ListArray) -> np.ndarray:
    """The sum of the weights at the places of each list."""
    offsets = lists.offsets.to_numpy()
    places = lists.values.to_numpy(zero_copy_only=False)[offsets[0] : offsets[-1]]
    rows = np.repeat(np.arange(len(lists)), np.diff(offsets))
    return np.bincount(rows, weights=weights[places], minlength=len(lists))


@dataclass
class CoTrained:
    """Both views, their calibrations and the regression that joins them."""

    mean: np.ndarray
    spread: np.ndarray
    models: list[Logistic]
    scale: list[Logistic]
    joint: Logistic

    def view_odds(self, batch: pa.RecordBatch) -> list[np.ndarray]:
        """Log odds of the text and of the metadata; columns text, style, meta."""
        text, meta = self.models
        n = batch.num_rows
        style = batch.column("style").flatten().to_numpy(zero_copy_only=False).reshape(n, STYLE)
        known = len(text.w) - STYLE
        content = _sums(text.w[:known], batch.column("text")) if known else np.zeros(n)
        content = content + ((style - self.mean) / self.spread) @ text.w[known:].astype(float) + text.b
        return [content, _sums(meta.w, batch.column("meta")) + meta.b]

    def joined(self, odds: list[np.ndarray]) -> np.ndarray:
        calibrated = [s.log_odds(o[:, None] / 10) for s, o in zip(self.scale, odds, strict=True)]
        return _sigmoid(self.joint.log_odds(np.stack(calibrated, 1)))


def fit(n_features: int, labelled: list[Example], y: np.ndarray, handed: list[list[tuple[Example, int]]]) -> CoTrained:
    """``handed``: pseudo-labelled examples for the view of the text and that of the metadata."""
    style = np.array([r.style for r in labelled])
    mean, spread = style.mean(0), style.std(0) + 1e-3

    def content(rows: list[Example]) -> np.ndarray:
        x = np.zeros((len(rows), n_features + STYLE), dtype=np.float32)
        for i, r in enumerate(rows):
            x[i, r.text] = 1
            x[i, n_features:] = (np.array(r.style) - mean) / spread
        return x

    def metadata(rows: list[Example]) -> np.ndarray:
        x = np.zeros((len(rows), META), dtype=np.float32)
        for i, r in enumerate(rows):
            np.add.at(x[i], r.meta, 1)
        return x

    held = np.arange(len(labelled)) % 4 == 0
    if len(set(y[held])) < 2 or len(set(y[~held])) < 2:
        held = np.zeros(len(labelled), dtype=bool)
    trained = [e for e, h in zip(labelled, held, strict=True) if not h]
    tested = [e for e, h in zip(labelled, held, strict=True) if h]
    y_tested = y[held] if tested else y
    models, odds = [], []
    for make, more in zip((content, metadata), handed, strict=True):
        # One matrix a view: those of training, those handed over, those held out.
        x = make([*trained, *[e for e, _ in more], *tested])
        n = len(trained) + len(more)
        models.append(Logistic().fit(x[:n], np.append(y[~held], [label for _, label in more])))
        odds.append(models[-1].log_odds(x[n:] if tested else x[: len(trained)]))
    # Calibration maps each view's log odds to those of the held-out labels.
    scale = [Logistic(1e-3).fit(o[:, None].astype(np.float32) / 10, y_tested) for o in odds]
    joint = np.stack([s.log_odds(o[:, None] / 10) for s, o in zip(scale, odds, strict=True)], 1)
    return CoTrained(mean, spread, models, scale, Logistic(1e-3).fit(joint.astype(np.float32), y_tested))


def surest(pool: DataFrame, model: CoTrained, done: set[int]) -> list[tuple[int, int, int, Example]]:
    """view, label, mark, example: those of all rows of ``pool`` that a view is most sure of.

    ``pool``: text, style, meta, mark.  ``done``: marks that are not asked for again.
    """
    sent = pool.sparkSession.sparkContext.broadcast((model, frozenset(done)))
    schema = pa.schema([("view", pa.int32()), ("label", pa.int32()), ("sure", pa.float64()), *_VECTOR])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted, left_out = sent.value
        best: dict[tuple[int, int], dict[int, tuple[float, Example]]] = {(v, k): {} for v in (0, 1) for k in (0, 1)}
        for batch in batches:
            if not batch.num_rows:
                continue
            marks = batch.column("mark").to_numpy()
            for view, odds in enumerate(fitted.view_odds(batch)):
                for label in (0, 1):
                    sure = _sigmoid(odds if label else -odds)
                    held = best[view, label]
                    least = min(x[0] for x in held.values()) if len(held) >= HANDED_OVER else SURE
                    at = np.flatnonzero(sure >= max(SURE, least))
                    order = at[np.lexsort((marks[at], -sure[at]))]
                    taken = 0
                    for i in order.tolist():
                        mark = int(marks[i])
                        if mark in left_out or mark in held:
                            continue
                        held[mark] = (float(sure[i]), _example(*[batch.column(c)[i].as_py() for c in ("text", "style", "meta")]))
                        taken += 1
                        if taken >= HANDED_OVER:
                            break
                    if len(held) > HANDED_OVER:
                        kept = sorted(held, key=lambda m: (-held[m][0], m))[:HANDED_OVER]
                        best[view, label] = {m: held[m] for m in kept}
        out: dict[str, list] = {f.name: [] for f in schema}
        for (view, label), held in best.items():
            for mark, (sure, example) in held.items():
                for name, value in zip(out, (view, label, sure, *example, mark), strict=True):
                    out[name].append(value)
        yield record_batch(out, schema)

    found = pool.select("text", "style", "meta", "mark").mapInArrow(run, "view int, label int, sure double, " + VECTOR_SQL)
    # In two steps: every task sends some rows, so the best of each of SHARES shares are found first.
    within = Window.partitionBy("view", "label", "share").orderBy(F.desc("sure"), "mark")
    once = found.dropDuplicates(["view", "label", "mark"]).withColumn("share", F.pmod(F.xxhash64("mark"), F.lit(SHARES)))
    first = once.withColumn("place", F.row_number().over(within)).filter(F.col("place") <= HANDED_OVER)
    order = Window.partitionBy("view", "label").orderBy(F.desc("sure"), "mark")
    best = first.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= HANDED_OVER)
    rows = best.select("view", "label", "mark", "place", "text", "style", "meta").collect()
    return [(r["view"], r["label"], r["mark"], _example(r["text"], r["style"], r["meta"])) for r in sorted(rows, key=lambda r: (r["view"], r["label"], r["place"]))]


def train(known: DataFrame, sampled: DataFrame, features: list[bytes], table: DataFrame) -> CoTrained | None:
    """``table``: doc_id and the vectors of all documents; ``known``: the labels by document."""
    spark = table.sparkSession
    rows = sorted(_featured(sampled.select("doc_id", "low", "toxic", "raw", "source", "lang", "n_chars"), features).collect(), key=lambda r: r["doc_id"])
    labelled = [_example(r["text"], r["style"], r["meta"]) for r in rows]
    y = np.array([int(not r["low"] and not r["toxic"]) for r in rows])
    if len(set(y.tolist())) < 2:
        return None
    pool = cut(table.select("doc_id", "text", "style", "meta", "mark").join(known.select("doc_id"), "doc_id", "left_anti").drop("doc_id"), "pool")
    handed: list[list[tuple[Example, int]]] = [[], []]
    done: set[int] = set()
    model = in_task(spark, fit, len(features), labelled, y, handed)
    for _ in range(ROUNDS):
        found = surest(pool, model, done)
        if not found:
            break
        for view, label, mark, example in found:
            if mark not in done:
                done.add(mark)
                handed[1 - view].append((example, label))
        model = in_task(spark, fit, len(features), labelled, y, handed)
    return model


def _scored(docs: DataFrame, labels: DataFrame, columns: list[str]) -> DataFrame:
    """row (a struct of these columns of ``docs``), score."""
    spark = docs.sparkSession
    small_batches(spark)
    known = _labels(labels)
    sampled = _sample(docs, known)
    features = _chosen_features(sampled)
    names = [f"c{i}" for i in range(len(columns))]
    plain = [docs[f"`{c}`"].alias(a) for c, a in zip(columns, names, strict=True)]
    given = docs.select(*plain, docs["doc_id"].cast("long").alias("doc_id"), *_metadata(docs))
    # Written once: rounds and scores read lists of numbers, not texts.
    table = cut(_featured(given, features), "features")
    model = spark.sparkContext.broadcast(train(known, sampled, features, table))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = np.ones(batch.num_rows)
            if model.value is not None and batch.num_rows:
                scores = model.value.joined(model.value.view_odds(batch)).astype(float)
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in range(len(names))], pa.array(scores)], names=[*names, "score"])

    schema = table.select(*names).schema.add("score", "double")
    row = F.struct(*[F.col(a).alias(c) for a, c in zip(names, columns, strict=True)])
    return table.select(*names, "text", "style", "meta").mapInArrow(run, schema).select(row.alias("row"), "score")


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, score (chance of a good document), kept: a row per row of ``docs``."""
    scored = _scored(docs, labels, ["doc_id"])
    return scored.select(F.col("row.doc_id").cast("long").alias("doc_id"), "score", (F.col("score") >= KEEP_FROM).alias("kept"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, that the classifier does not reject."""
    return _scored(docs, labels, docs.columns).filter(F.col("score") >= KEEP_FROM).select("row.*")
