"""A stored index for nearest vectors: inverted lists with residual codes.

``build_index`` fits centroids on a bounded sample, deals every usable vector to the list
of its nearest centroid and stores, below one folder,

- ``codes``: blocks of a list's vectors as one byte for each component of the residual,
  with a bound on the error of each, in folders by list;
- ``vectors``: the vectors themselves with their codes, in folders by list;
- ``lists``: centroid, number of vectors and the cosine of the farthest member of each list;
- ``about``: one row for ``list_indexes``.

A search reads the codes and vectors of the lists that its queries probe (folders of
other lists are pruned).  The answers' scores are exact cosines.  By default the lists whose centroids are nearest are probed, as many as gave
the wanted recall on the sample.  With ``exact``, the answers so found only set a limit:
every list that could hold a vector as near, by the angle of its farthest member, is
scanned, and every code that could be as near, by its error, is scored, so the answers
are those of a scan of all vectors.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import vectors as vf

#: Bounds of the sample that centroids are fitted on: vectors, and bytes.
SAMPLE, SAMPLE_BYTES = 16_384, 64 << 20
#: Lists at most, and rounds of fitting.
MAX_LISTS, ROUNDS = 4096, 8
#: Codes of a block, queries that meet it as one matrix, candidates for each answer.
CODE_BLOCK, QUERY_BLOCK, CANDIDATES = 4096, 512, 4
#: Queries of the sample that set the number of probes.
TRIALS = 200
ABOUT = "name string, property string, dimensions int, similarity string, lists int, probes int, entries long, state string"
#: Wider than rounding, so that it never loses an answer.
SLACK = 1e-6


def _usable(rows: DataFrame, key: str, vector: str, dim: int | None = None) -> DataFrame:
    """id, vector of rows that are similar to any: not null, not zero, finite, ``dim`` long."""
    plain = rows.select(F.col(key).alias("id"), F.col(vector).cast("array<double>").alias("vector"))
    norm = vf.norm(F.col("vector"))
    good = plain.filter(F.col("id").isNotNull() & (norm > 0) & (norm < float("inf")))
    return good if dim is None else good.filter(F.size("vector") == dim)


def _units(arrays: pa.Array, dim: int) -> np.ndarray:
    x = arrays.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def fitted(sample: np.ndarray, lists: int, recall: float, k: int) -> tuple[np.ndarray, int]:
    """Unit centroids of the rows of ``sample``, and how many lists give ``recall`` of the best ``k`` in it."""
    means = sample[:lists].copy()
    for _ in range(ROUNDS):
        own = (sample @ means.T).argmax(axis=1)
        sums = np.zeros_like(means)
        np.add.at(sums, own, sample)
        length = np.sqrt((sums * sums).sum(axis=1))
        means[length > 0] = sums[length > 0] / length[length > 0, None]
    own = (sample @ means.T).argmax(axis=1)
    asked = np.arange(0, len(sample), max(1, len(sample) // TRIALS))
    scores = sample[asked] @ sample.T
    scores[np.arange(len(asked)), asked] = -np.inf
    best = np.argsort(-scores, axis=1, kind="stable")[:, : min(k, len(sample) - 1)]
    # The place, among a query's lists, of the list that holds each of its answers.
    place = np.argsort(np.argsort(-(sample[asked] @ means.T), axis=1, kind="stable"), axis=1, kind="stable")
    needed = np.sort(place[np.arange(len(asked))[:, None], own[best]].ravel()) if best.size else np.zeros(1, dtype=int)
    return means, int(needed[min(len(needed) - 1, int(np.ceil(recall * len(needed))))]) + 1


def build_index(
    vectors: DataFrame, path: str, name: str = "embedding", key: str = "id", vector: str = "embedding", dim: int | None = None, lists: int | None = None, recall: float = 0.97, k: int = 10
) -> None:
    """Index all of ``vectors`` that have ``dim`` components (default: the commonest number) below ``path``.

    ``lists``: by default the root of the number of vectors, at most MAX_LISTS.  An
    index that is there is replaced.  Vectors that are zero, null or not finite, and
    rows without a key, are not indexed, as no search finds them.
    """
    spark = vectors.sparkSession
    if dim is None:
        common = _usable(vectors, key, vector).groupBy(F.size("vector").alias("dim")).count().orderBy(F.desc("count"), "dim").first()
        dim = common["dim"] if common else 0
    usable = _usable(vectors, key, vector, dim)
    n = usable.count()
    lists = max(1, min(lists or int(np.ceil(np.sqrt(n))), MAX_LISTS, n))
    size = min(SAMPLE, SAMPLE_BYTES // max(8 * dim, 1))
    share = F.lit(int(min(1.0, size / max(n, 1)) * (1 << 30)))
    sample = usable.filter(F.pmod(F.xxhash64("id", "vector"), F.lit(1 << 30)) < share).select(F.lit(0).alias("all"), "id", "vector")

    def fit(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("id")
        x = np.stack(rows["vector"].to_numpy())
        x /= np.sqrt((x * x).sum(axis=1, keepdims=True))
        means, probes = fitted(x[np.random.default_rng(0).permutation(len(x))], lists, recall, k)
        return pd.DataFrame({"centroid": list(means), "probes": probes})

    made = sample.groupBy("all").applyInPandas(fit, "centroid array<double>, probes int").collect()
    means = np.array([r["centroid"] for r in made]).reshape(-1, dim or 1)
    sent = spark.sparkContext.broadcast(means)
    _dealt(usable, sent, dim, path)
    probes = made[0]["probes"] if made else 0
    _about(spark, path, name, vector, dim, probes, sent)


def _dealt(usable: DataFrame, sent, dim: int, path: str) -> None:  # noqa: ANN001
    """Write vectors and codes by list."""
    kind = usable.schema["id"].dataType.simpleString()

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        means = sent.value
        for batch in batches:
            unit = _units(batch.column(1), dim)
            near = unit @ means.T
            own = near.argmax(axis=1)
            rest = unit - means[own]
            low = rest.min(axis=1, keepdims=True)
            step = np.maximum((rest.max(axis=1, keepdims=True) - low) / 255.0, 1e-12)
            codes = np.rint((rest - low) / step).astype(np.uint8)
            error = np.sqrt(((codes * step + low - rest) ** 2).sum(axis=1))
            columns = [batch.column(0), batch.column(1), pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(low[:, 0]), pa.array(step[:, 0]), pa.array(error), pa.array(near[np.arange(len(own)), own]), pa.array(own, pa.int32())]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "vector", "code", "low", "step", "error", "near", "list"])

    coded = usable.mapInArrow(code, f"id {kind}, vector array<double>, code binary, low double, step double, error double, near double, list int")
    # A list that is much larger than others is split over tasks by the adaptive plan.
    coded.hint("rebalance", "list").write.mode("overwrite").partitionBy("list").parquet(f"{path}/vectors")
    rows = usable.sparkSession.read.schema(coded.schema).parquet(f"{path}/vectors")
    counts = rows.groupBy("list").agg(F.count(F.lit(1)).alias("n"))
    block = F.pmod(F.xxhash64("id"), F.ceil(F.col("n") / F.lit(CODE_BLOCK))).cast("int").alias("block")
    # At most MAX_LISTS rows.
    blocked = rows.join(F.broadcast(counts), "list").select("list", block, F.struct("id", "code", "low", "step", "error").alias("row"))
    held = blocked.groupBy("list", "block").agg(F.collect_list("row").alias("rows"))
    held.write.mode("overwrite").partitionBy("list").parquet(f"{path}/codes")


def _about(spark: SparkSession, path: str, name: str, vector: str, dim: int, probes: int, sent) -> None:  # noqa: ANN001
    rows = spark.read.parquet(f"{path}/vectors") if sent.value.size else None
    kind = "list int, centroid array<double>, n long, farthest double"
    centroids = spark.createDataFrame([(i, [float(v) for v in c]) for i, c in enumerate(sent.value)], "list int, centroid array<double>")
    if rows is None:
        lists = spark.createDataFrame([], kind)
    else:
        held = rows.groupBy("list").agg(F.count(F.lit(1)).alias("n"), F.min("near").alias("farthest"))
        lists = centroids.join(held, "list", "left").select("list", "centroid", F.coalesce("n", F.lit(0)).alias("n"), "farthest")
    lists.coalesce(1).write.mode("overwrite").parquet(f"{path}/lists")
    total = spark.read.schema(kind).parquet(f"{path}/lists").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("entries"), F.count(F.lit(1)).cast("int").alias("lists"))
    total.select(
        F.lit(name).alias("name"), F.lit(vector).alias("property"), F.lit(dim).cast("int").alias("dimensions"), F.lit("cosine").alias("similarity"), "lists", F.lit(probes).cast("int").alias("probes"), "entries", F.lit("ONLINE").alias("state")
    ).coalesce(1).write.mode("overwrite").json(f"{path}/about")


def list_indexes(spark: SparkSession, paths: list[str]) -> DataFrame:
    """A row of ABOUT for each index; an index is ONLINE once all its parts are written."""
    found = spark.createDataFrame([], ABOUT)
    for path in paths:
        found = found.unionByName(spark.read.schema(ABOUT).json(f"{path}/about"))
    return found


def search_index(spark: SparkSession, path: str, queries: DataFrame, k: int = 10, key: str = "id", vector: str = "embedding", probes: int | None = None, exact: bool = False) -> DataFrame:
    """query_id, id, score, rank of the best ``k`` for every query; ties by id.

    A query is left out of its own answers.  Queries that are zero, null or of another
    length have no answers.  ``probes``: lists to read, by default those that gave the
    recall asked for when the index was built.
    """
    about = spark.read.schema(ABOUT).json(f"{path}/about").first()
    if not about["entries"]:
        kind = queries.schema[key].dataType.simpleString()
        return spark.createDataFrame([], f"query_id {kind}, id {kind}, score double, rank int")
    # At most MAX_LISTS rows.
    lists = spark.read.parquet(f"{path}/lists").orderBy("list").collect()
    means = np.array([r["centroid"] for r in lists])
    widest = np.array([np.arccos(np.clip(r["farthest"], -1, 1)) if r["n"] else -np.inf for r in lists])
    sent = spark.sparkContext.broadcast((means, widest))
    asked = _usable(queries, key, vector, about["dimensions"]).withColumnRenamed("id", "query_id")
    many = max(1, -(-asked.count() // QUERY_BLOCK))
    first = _answers(spark, path, asked.withColumn("least", F.lit(None).cast("double")), sent, k, probes or about["probes"], many)
    if not exact:
        return first
    limits = first.groupBy("query_id").agg(F.when(F.count(F.lit(1)) >= k, F.min("score")).otherwise(F.lit(-2.0)).alias("least"))
    limited = asked.join(limits, "query_id", "left").withColumn("least", F.coalesce("least", F.lit(-2.0)))
    return _answers(spark, path, limited, sent, k, 0, many)


def _answers(spark: SparkSession, path: str, asked: DataFrame, sent, k: int, probes: int, many: int) -> DataFrame:  # noqa: ANN001
    """Best ``k`` of the ``probes`` nearest lists, or of all that may hold a score of ``least``; queries come in ``many`` parts."""
    dim = sent.value[0].shape[1]
    asking, answering = asked.schema["query_id"].dataType.simpleString(), spark.read.parquet(f"{path}/vectors").schema["id"].dataType.simpleString()

    def probed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        means, widest = sent.value
        for batch in batches:
            unit = _units(batch.column(1), dim)
            near = unit @ means.T
            if probes:
                order = np.argsort(-near, axis=1, kind="stable")[:, :probes]
                at, own = np.repeat(np.arange(len(unit)), order.shape[1]), order.ravel()
            else:
                # No member of a list is nearer than the angle to it less that of its farthest member.
                bound = np.cos(np.maximum(0.0, np.arccos(np.clip(near, -1, 1)) - widest[None, :]))
                bound[:, np.isneginf(widest)] = -np.inf
                at, own = np.nonzero(bound >= batch.column(2).to_numpy(zero_copy_only=False)[:, None] - SLACK)
            vectors = pa.ListArray.from_arrays(pa.array(np.arange(len(at) + 1) * dim, pa.int32()), pa.array(unit[at].ravel()))
            held = batch.take(pa.array(at))
            yield pa.RecordBatch.from_arrays([pa.array(own, pa.int32()), held.column(0), vectors, held.column(2)], names=["list", "query_id", "unit", "least"])

    dealt = asked.select("query_id", "vector", "least").repartition(many, "query_id")
    wanted = dealt.mapInArrow(probed, f"list int, query_id {asking}, unit array<double>, least double")
    grouped = wanted.groupBy("list", F.pmod(F.xxhash64("query_id"), F.lit(many)).alias("part")).agg(F.collect_list(F.struct("query_id", "unit", "least")).alias("asked"))
    codes = spark.read.schema(f"rows array<struct<id:{answering},code:binary,low:double,step:double,error:double>>, list int").parquet(f"{path}/codes")
    # At most MAX_LISTS rows, which prune folders.  The lists' queries and candidates are many
    # times what the planner expects of the functions that make them: they are never broadcast.
    read = F.broadcast(wanted.select("list").distinct())
    pairs = codes.join(read, "list", "left_semi").join(grouped.hint("merge"), "list").select("list", "rows", "asked")
    most = k * CANDIDATES

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        means, _ = sent.value
        for batch in batches:
            for own, rows, queries in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2), strict=True):
                rows, queries = rows.values, queries.values
                ids, low, step, error = (rows.field(c).to_numpy(zero_copy_only=False) for c in ("id", "low", "step", "error"))
                raw = np.frombuffer(b"".join(rows.field("code").to_pylist()), np.uint8).reshape(-1, dim)
                q = queries.field("unit").flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
                about = q @ (means[own] + raw * step[:, None] + low[:, None]).T
                names = queries.field("query_id").to_numpy(zero_copy_only=False)
                about[names[:, None] == ids[None, :]] = -np.inf
                if probes:
                    least = -np.partition(-about, most - 1, axis=1)[:, most - 1 : most] if about.shape[1] > most else np.full((len(names), 1), -2.0)
                    at, found = np.nonzero(about >= np.maximum(least, -2.0))
                else:
                    least = queries.field("least").to_numpy()[:, None]
                    at, found = np.nonzero(about + error[None, :] >= least - SLACK)
                yield pa.RecordBatch.from_arrays([pa.array(names[at]), pa.array(ids[found]), pa.array(about[at, found]), pa.array(np.full(len(at), own), pa.int32())], names=["query_id", "id", "about", "list"])

    found = pairs.mapInArrow(scan, f"query_id {asking}, id {answering}, about double, list int")
    if probes:
        place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("about"), "id"))
        found = found.withColumn("place", place).filter(F.col("place") <= most)
    vectors = spark.read.schema(f"id {answering}, vector array<double>, list int").parquet(f"{path}/vectors")
    met = found.select("query_id", "id", "list").hint("merge").join(vectors.join(read, "list", "left_semi"), ["list", "id"]).join(asked.select("query_id", F.col("vector").alias("q")), "query_id")
    scored = met.select("query_id", "id", vf.cosine(F.col("vector"), F.col("q")).alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "id"))
    return scored.withColumn("rank", rank).filter(F.col("rank") <= k)


def recall(found: DataFrame, exact: DataFrame) -> DataFrame:
    """One row: n_queries, n_exact (answers of ``exact``), n_found (those that ``found`` has too) and their share."""
    both = exact.select("query_id", "id").join(found.select("query_id", "id", F.lit(1).alias("hit")), ["query_id", "id"], "left")
    counted = both.agg(F.count_distinct("query_id").alias("n_queries"), F.count(F.lit(1)).alias("n_exact"), F.count("hit").alias("n_found"))
    return counted.withColumn("recall", F.coalesce(F.try_divide(F.col("n_found"), F.col("n_exact")), F.lit(1.0)))
