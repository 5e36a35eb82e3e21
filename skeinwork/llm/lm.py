"""Language-model scoring with a class-based log-bilinear model (operator 10).

Counts of all training tokens give the base score.  The model predicts a token from
the two tokens before it in two levels: its class by a log-bilinear net, and the
token within its class by smoothed counts.  The most frequent words and the end are
classes of their own.  Some ten thousands of further words are clustered by the
words that stand beside them: their counts next to each of the most frequent words,
on either side, over the whole training part.  All other words share one class, in
which unknown words have the share of one unseen word.

The net is trained in numpy with noise-contrastive estimation.  Its data are the
counts of all class triples of the whole training part, of which there are at most
``CLASSES`` cubed; the more different ones the corpus has, the more steps are made.
Batched matrix products over the contexts then give log probabilities normalised
over all classes, which documents look up.

A bounded list of the most frequent words is sent to the executors, and settles
most tokens where the text is read.  Other words go through a join with the table of
counts as (document, word) rows; a frequent word that is too long to be sent makes
at most one row a document there, and that join can be split where it is hot.

Null text has the end token only.  A null doc_id counts as training (remainder 0).
Repeated rows are counted and scored as often as they come.  An empty table gives
an empty result; without training rows every word is unknown.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, in_task, record_batch, small_batches, utf8

FOLDS, HELD_OUT = 7, 2
#: Classes: frequent words, clusters of words, then the end, other words, and the start
#: (context only).
CLASSES, SINGLES = 96, 45
END, OTHER, START = CLASSES - 3, CLASSES - 2, CLASSES - 1
#: Words that are put in classes, and frequent words beside which they are counted.
CLASSED_WORDS, BESIDE = 30_000, 32
#: Words that are sent to the executors with their counts, of at most so many bytes.
SENT_WORDS, SENT_BYTES = 150_000, 48
#: Distinct words that a task counts before it passes them on.
TASK_WORDS = 300_000
#: Training of the net.
DIMENSIONS, BATCH, NOISE, RATE, SEED = 24, 2048, 64, 0.15, 7
#: Draws for each different triple, and clustering rounds.
PASSES, ROUNDS = 6, 15


def _tokens(raw: bytes) -> list[bytes]:
    return raw.lower().split()


def _parts(docs: DataFrame) -> DataFrame:
    doc_id = docs["doc_id"].cast("long")
    fold = F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(FOLDS))
    return docs.select(doc_id.alias("doc_id"), (fold == HELD_OUT).alias("held_out"), utf8(docs["text"]).alias("raw"))


def token_counts(training: DataFrame) -> DataFrame:
    """token (binary; empty for the end) and c, over a column ``raw``."""
    schema = pa.schema([("token", pa.binary()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for raw in batch.column(0):
                counts.update(_tokens(raw.as_py()))
            counts[b""] += batch.num_rows
            if len(counts) > TASK_WORDS:
                yield from _sent(counts, schema)
                counts = Counter()
        yield from _sent(counts, schema)

    found = training.select("raw").mapInArrow(run, "token binary, n long")
    return found.groupBy("token").agg(F.sum("n").alias("c")).filter("c > 0")


def frequent_words(counts: DataFrame) -> dict[bytes, int]:
    """The most frequent words with their counts, as many whole steps of the logarithm
    of the count as hold no more than SENT_WORDS; the end and long words are left out."""
    short = counts.filter(F.octet_length("token").between(1, SENT_BYTES)).withColumn("step", F.floor(F.log2("c") * 8).cast("int"))
    room, lowest = SENT_WORDS, None
    # Eight steps for each doubling: a few hundred rows.
    for row in short.groupBy("step").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("step")).collect():
        room -= row["n"]
        if room < 0:
            break
        lowest = row["step"]
    if lowest is None:
        return {}
    return {bytes(r["token"]): r["c"] for r in short.filter(F.col("step") >= lowest).select("token", "c").collect()}


def _sent(counts: Counter, schema: pa.Schema, size: int = 50_000) -> Iterator[pa.RecordBatch]:
    keys, values = list(counts), list(counts.values())
    for i in range(0, len(keys), size):
        yield record_batch({schema.names[0]: keys[i : i + size], schema.names[1]: values[i : i + size]}, schema)


def class_ids(words: list[bytes], classes: dict[bytes, int]) -> np.ndarray:
    """Start, start, the words' classes, end."""
    out = np.empty(len(words) + 3, dtype=np.int64)
    out[:2] = START
    out[2:-1] = np.fromiter(map(classes.get, words, repeat(OTHER)), dtype=np.int64, count=len(words))
    out[-1] = END
    return out


def triple_codes(ids: np.ndarray) -> np.ndarray:
    return (ids[:-2] * CLASSES + ids[1:-1]) * CLASSES + ids[2:]


def _cell_counts(training: DataFrame, shared: object, cells: int, codes_of) -> np.ndarray:  # noqa: ANN001
    """How often each code from 0 to ``cells`` comes out of ``codes_of(tokens, shared)``."""
    sent = training.sparkSession.sparkContext.broadcast(shared)
    schema = pa.schema([("code", pa.int32()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(cells, dtype=np.int64)
        for batch in batches:
            for raw in batch.column(0):
                codes = codes_of(_tokens(raw.as_py()), sent.value)
                if len(codes) > cells // 8:
                    total += np.bincount(codes, minlength=cells)
                else:
                    np.add.at(total, codes, 1)
        code = np.nonzero(total)[0]
        for i in range(0, len(code), 50_000):
            part = code[i : i + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), pa.array(total[part])], schema=schema)

    found = training.select("raw").mapInArrow(run, "code int, n long").groupBy("code").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(cells)
    out[found.column("code").to_numpy()] = found.column("n").to_numpy()
    return out


def beside_codes(tokens: list[bytes], places: dict[bytes, int]) -> np.ndarray:
    """Codes (word, side, frequent word) of the words with a place next to one of the first ``BESIDE``."""
    at = np.fromiter(map(places.get, tokens, repeat(-1)), dtype=np.int64, count=len(tokens))
    out = []
    for side, words, others in ((0, at[1:], at[:-1]), (1, at[:-1], at[1:])):
        on = (words >= 0) & (others >= 0) & (others < BESIDE)
        out.append((words[on] * 2 + side) * BESIDE + others[on])
    return np.concatenate(out)


def clustered(counts: np.ndarray, weights: np.ndarray, clusters: int) -> np.ndarray:
    """A cluster for each row of ``counts``, by k-means over the roots of the rows' shares."""
    # A little of the mean row draws words without much evidence to the middle.
    mean = counts.sum(0) / max(1.0, counts.sum())
    smooth = counts + 2.0 * mean
    x = np.sqrt(smooth / np.maximum(smooth.sum(1, keepdims=True), 1e-12))
    weights = weights / weights.sum()
    rng = np.random.default_rng(SEED)
    centres = x[[int(rng.choice(len(x), p=weights))]]
    gap = np.full(len(x), np.inf)
    for _ in range(min(clusters, len(x)) - 1):
        gap = np.minimum(gap, ((x - centres[-1]) ** 2).sum(1))
        chance = gap * weights
        if chance.sum() <= 0:
            break
        centres = np.vstack([centres, x[int(rng.choice(len(x), p=chance / chance.sum()))]])
    for _ in range(ROUNDS):
        of = np.argmax(x @ centres.T - (centres**2).sum(1) / 2, axis=1)
        mass = np.bincount(of, weights, minlength=len(centres))
        moved = np.stack([np.bincount(of, weights * column, minlength=len(centres)) for column in x.T], 1)
        filled = mass > 0
        centres[filled] = moved[filled] / mass[filled, None]
    return of


def word_classes(training: DataFrame, words: list[tuple[bytes, int]]) -> dict[bytes, int]:
    """The class of each word of ``words`` (with counts, most frequent first)."""
    classes = {w: i for i, (w, _) in enumerate(words[:SINGLES])}
    rest = words[SINGLES:]
    if rest:
        places = {w: i for i, (w, _) in enumerate(words)}
        cells = _cell_counts(training, places, len(words) * 2 * BESIDE, beside_codes).reshape(len(words), 2 * BESIDE)
        of = in_task(training.sparkSession, clustered, cells[SINGLES:], np.array([float(n) for _, n in rest]), END - SINGLES)
        classes |= {w: SINGLES + int(c) for (w, _), c in zip(rest, of, strict=True)}
    return classes


def _triples(tokens: list[bytes], classes: dict[bytes, int]) -> np.ndarray:
    return triple_codes(class_ids(tokens, classes))


def triple_counts(training: DataFrame, classes: dict[bytes, int]) -> np.ndarray:
    """How often each class follows each pair of classes: CLASSES cubed counts."""
    return _cell_counts(training, classes, CLASSES**3, _triples).reshape(CLASSES, CLASSES, CLASSES)


class LogBilinear:
    """Scores q(context) . v(class) + b(class), with q a sum of a matrix for each place."""

    def __init__(self, unigram: np.ndarray, seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.context = rng.normal(0, 0.1, (CLASSES, DIMENSIONS))
        self.place = rng.normal(0, 0.1, (2, DIMENSIONS, DIMENSIONS)) + np.eye(DIMENSIONS)
        self.output = rng.normal(0, 0.1, (CLASSES, DIMENSIONS))
        self.bias = np.log(unigram)
        self.rng = rng

    def query(self, before: np.ndarray, last: np.ndarray) -> np.ndarray:
        return self.context[before] @ self.place[0] + self.context[last] @ self.place[1]

    def fit(self, counts: np.ndarray, noise: np.ndarray) -> None:
        """Noise-contrastive estimation with Adagrad over triples drawn by their counts."""
        codes = np.nonzero(counts.ravel())[0]
        steps = 300 + PASSES * len(codes) // BATCH
        edges = np.cumsum(counts.ravel()[codes])
        names = ("context", "place", "output", "bias")
        squares = {n: np.full_like(getattr(self, n), 1e-4) for n in names}
        log_noise = np.log(noise * NOISE)
        noise_edges = np.cumsum(noise)
        unit = np.eye(CLASSES)
        for _ in range(steps):
            at = np.searchsorted(edges, self.rng.random(BATCH) * edges[-1], side="right")
            code = codes[np.minimum(at, len(codes) - 1)]
            a, b, w = code // CLASSES**2, code // CLASSES % CLASSES, code % CLASSES
            other = np.minimum(np.searchsorted(noise_edges, self.rng.random(NOISE)), CLASSES - 1)
            q = self.query(a, b)
            # Probability of "from the data" for the true class and for the noise.
            true = (q * self.output[w]).sum(1) + self.bias[w] - log_noise[w]
            false = q @ self.output[other].T + self.bias[other] - log_noise[other]
            g_true = 1 / (1 + np.exp(np.clip(true, -30, 30)))
            g_false = -1 / (1 + np.exp(np.clip(-false, -30, 30)))
            g_q = g_true[:, None] * self.output[w] + g_false @ self.output[other]
            # One-hot matrices gather the gradients of a class's rows in one product.
            hot_a, hot_b, hot_w, hot_other = unit[a], unit[b], unit[w], unit[other]
            grads = {
                "context": hot_a.T @ (g_q @ self.place[0].T) + hot_b.T @ (g_q @ self.place[1].T),
                "place": np.stack([self.context[a].T @ g_q, self.context[b].T @ g_q]),
                "output": hot_w.T @ (g_true[:, None] * q) + hot_other.T @ (g_false.T @ q),
                "bias": hot_w.T @ g_true + hot_other.T @ g_false.sum(0),
            }
            for n in names:
                g = grads[n] / BATCH
                squares[n] += g * g
                getattr(self, n).__iadd__(RATE * g / np.sqrt(squares[n]))

    def log_probabilities(self, possible: np.ndarray) -> np.ndarray:
        """Natural logs, normalised over the possible classes, for all contexts, one batch for each class before."""
        out = np.empty((CLASSES, CLASSES, CLASSES))
        every = np.arange(CLASSES)
        for before in range(CLASSES):
            s = self.query(np.full(CLASSES, before), every) @ self.output.T + self.bias
            s[:, ~possible] = -np.inf
            top = s.max(1, keepdims=True)
            out[before] = s - top - np.log(np.exp(s - top).sum(1, keepdims=True))
        return out


def train(counts: np.ndarray) -> np.ndarray:
    """Log10 probabilities [class before, last class, class] from triple counts."""
    seen = counts.sum((0, 1))
    possible = seen > 0
    possible[[END, OTHER]] = True
    smoothed = np.where(possible, seen + 0.5, 1e-6)
    unigram = smoothed / smoothed.sum()
    model = LogBilinear(unigram)
    if counts.sum():
        model.fit(counts, unigram)
    return model.log_probabilities(possible) / math.log(10)


def _within(classed: list[tuple[bytes, int]], classes: dict[bytes, int]) -> dict[bytes, float]:
    """Log10 probability of each word within its class, by counts plus one."""
    totals = np.zeros(CLASSES)
    for w, c in classed:
        totals[classes[w]] += c + 1
    return {w: math.log10((c + 1) / totals[classes[w]]) for w, c in classed}


def lm_scores(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score; see the module."""
    spark = docs.sparkSession
    small_batches(spark)
    parts = _parts(docs)
    training = parts.filter("not held_out")
    counts = cut(token_counts(training), "counts")
    n_all, v_all = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    words = frequent_words(counts)
    end_count = counts.filter(F.octet_length("token") == 0).agg(F.coalesce(F.sum("c"), F.lit(0))).first()[0]
    classed = sorted(words.items(), key=lambda x: (-x[1], x[0]))[:CLASSED_WORDS]
    classes = word_classes(training, classed)
    logs = in_task(spark, train, triple_counts(training, classes)).astype(np.float32)
    within = _within(classed, classes)
    other_tokens = n_all - end_count - sum(c for _, c in classed)
    other_words = v_all - (end_count > 0) - len(classed)
    base_unit = math.log10(n_all + v_all + 1)
    other_unit = math.log10(other_tokens + other_words + 1)
    sent = spark.sparkContext.broadcast((words, classes, within, logs.ravel(), end_count))
    fields = {
        "rid": pa.int64(), "doc_id": pa.int64(), "held_out": pa.bool_(), "n_tokens": pa.int64(), "n_known": pa.int64(),
        "n_other": pa.int64(), "log_sent": pa.float64(), "log_other": pa.float64(), "lm": pa.float64(),
        "rare": pa.list_(pa.binary()), "times": pa.list_(pa.int32()),
    }
    schema = pa.schema(list(fields.items()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, class_of, in_class, logs, ends = sent.value
        log_of = {w: math.log10(c + 1) for w, c in known.items()}
        for batch in batches:
            out: dict[str, list] = {f: [] for f in fields}
            for f in ("rid", "doc_id", "held_out"):
                out[f] = batch.column(f).to_pylist()
            for raw in batch.column("raw"):
                tokens = _tokens(raw.as_py())
                ids = class_ids(tokens, class_of)
                n_known, n_classed, log_sent, log_other, log_class = int(ends > 0), 0, math.log10(ends + 1), 0.0, 0.0
                rare, times = [], []
                for word, n in Counter(tokens).items():
                    log = log_of.get(word)
                    if log is None:
                        rare.append(word)
                        times.append(n)
                        continue
                    n_known += n
                    log_sent += n * log
                    inner = in_class.get(word)
                    if inner is None:
                        log_other += n * log
                    else:
                        n_classed += n
                        log_class += n * inner
                out["n_tokens"].append(len(tokens) + 1)
                out["n_known"].append(n_known)
                out["n_other"].append(len(tokens) - n_classed)
                out["log_sent"].append(log_sent)
                out["log_other"].append(log_other)
                out["lm"].append(float(logs[triple_codes(ids)].sum(dtype=np.float64)) + log_class)
                out["rare"].append(rare)
                out["times"].append(times)
            yield record_batch(out, schema)

    read = parts.select(F.monotonically_increasing_id().alias("rid"), "doc_id", "held_out", "raw")
    sql = (
        "rid long, doc_id long, held_out boolean, n_tokens long, n_known long, n_other long, log_sent double, "
        "log_other double, lm double, rare array<binary>, times array<int>"
    )
    # Written once, so that both branches below see the same row numbers.
    scored = cut(read.mapInArrow(run, sql), "scored")
    rare = scored.select("rid", F.explode(F.arrays_zip("rare", "times")).alias("x")).select(
        "rid", F.col("x.rare").alias("token"), F.col("x.times").alias("n")
    )
    found = rare.join(counts, "token").groupBy("rid").agg(
        F.sum("n").alias("more_known"), F.sum(F.col("n") * F.log10(F.col("c") + 1.0)).alias("log_rare")
    )
    log_rare = F.coalesce("log_rare", F.lit(0.0))
    return (
        scored.drop("rare", "times")
        .join(found, "rid", "left")
        .select(
            "doc_id",
            "held_out",
            "n_tokens",
            (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
            F.lit(int(n_all)).cast("long").alias("train_tokens"),
            (F.col("log_sent") + log_rare - F.col("n_tokens") * F.lit(base_unit)).alias("base_score"),
            (F.col("lm") + F.col("log_other") + log_rare - F.col("n_other") * F.lit(other_unit)).alias("score"),
        )
    )
