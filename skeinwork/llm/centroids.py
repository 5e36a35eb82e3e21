"""Clustering by centroids in exact integers (operator 12).

A vector's components become the integers ``floor(SCALE * x)``.  The first centroids
are the vectors whose hash is smallest; every round assigns each vector to its nearest
centroid (squared Euclidean distance; ties: the smaller number) and moves a centroid
to the componentwise floor of its vectors' mean.

Method: all distances of a block of vectors are one expansion |x|^2 - 2 x.c + |c|^2 with
a matrix product in float64.  Every term is an integer, so the product is exact as long
as no sum can reach 2^53; a bound on the magnitudes of a block and of the centroids
tells whether it can, and a block beyond it is computed in 64-bit or unbounded integers
instead.  Sums of components are guarded alike.  Each task turns its part into one
record of sums, and an RDD ``treeAggregate`` combines these, so the driver gets some
root of the number of parts; it holds the centroids only.

Vectors are kept if they have exactly ``dim`` components, none null or non-finite;
null vectors and others are left out of the result.  Repeated rows and ids are vectors
of their own; among equal hashes the least vector comes first, and a null id after all
others.  With fewer vectors than ``clusters`` there are as many centroids.  Distances and
inertias beyond a long are null (assignments are exact nevertheless); centroids come as
decimal integers in text, as their components may exceed a long.  An empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut

CLUSTERS, ROUNDS, DIM, SCALE = 16, 3, 64, 64
#: Vectors in one matrix product.
BLOCK = 4096
EXACT_FLOAT, EXACT_LONG = 1 << 53, 1 << 63


def usable(vectors: DataFrame, dim: int) -> DataFrame:
    """vec_id, x: the vectors of ``dim`` finite components, as arrays of doubles."""
    x = vectors["embedding"].cast("array<double>")
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != F.lit(float("inf"))))
    return vectors.select(vectors["vec_id"].cast("long").alias("vec_id"), x.alias("x")).filter((F.size("x") == dim) & F.coalesce(finite, F.lit(False)))


def integers(x: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """floor(scale * x): as float64 where all are below 2^53, else as Python integers.

    ``scale`` is a power of two, so the product is exact unless it overflows.
    """
    if not x.size or np.abs(x).max() < EXACT_FLOAT / scale:
        return np.floor(x * scale)
    # From 2^53 on a double is an integer itself.
    whole = [int(v) * scale if abs(v) >= EXACT_FLOAT else int(np.floor(v * scale)) for v in x.ravel().tolist()]
    made = np.empty(len(whole), dtype=object)
    made[:] = whole
    return made.reshape(x.shape)


def magnitude(m: np.ndarray) -> int:
    return int(abs(m).max()) if m.size else 0


def distances(x: np.ndarray, centroids: list[list[int]]) -> np.ndarray:
    """Squared distances of the rows of ``x`` (from ``integers``) to the centroids, exact.

    No partial sum of the expansion is beyond dim * (max|x| + max|c|)^2, whatever the
    order in which a product adds up.
    """
    c = np.array(centroids, dtype=object)
    bound = x.shape[1] * (magnitude(x) + magnitude(c)) ** 2
    if bound < EXACT_FLOAT:
        a, b = x.astype(np.float64), c.astype(np.float64)
        found = (a * a).sum(axis=1)[:, None] - 2.0 * (a @ b.T) + (b * b).sum(axis=1)[None, :]
        return found.astype(np.int64)
    kind = np.int64 if bound < EXACT_LONG else object
    a, b = _as(x, kind), c.astype(kind)
    return np.stack([((a - row) ** 2).sum(axis=1) for row in b], axis=1)


def _as(x: np.ndarray, kind: type) -> np.ndarray:
    if kind is object and x.dtype != object:
        made = np.empty(x.size, dtype=object)
        made[:] = [int(v) for v in x.ravel().tolist()]
        return made.reshape(x.shape)
    return x.astype(kind)


def sums_by(x: np.ndarray, cluster: np.ndarray, clusters: int) -> list[list[int]]:
    """Componentwise sums of the rows of each cluster, exact."""
    if len(x) * magnitude(x) < EXACT_FLOAT:
        member = np.zeros((clusters, len(x)))
        member[cluster, np.arange(len(x))] = 1.0
        return [[int(v) for v in row] for row in (member @ x.astype(np.float64)).tolist()]
    whole = _as(x, object)
    return [whole[cluster == i].sum(axis=0).tolist() if (cluster == i).any() else [0] * x.shape[1] for i in range(clusters)]


#: What a task makes of its part: counts, component sums, sums of distances; by cluster.
Totals = tuple[list[int], list[list[int]], list[int]]


def merged(a: Totals | None, b: Totals | None) -> Totals | None:
    if a is None or b is None:
        return a or b

    def added(x: list[int], y: list[int]) -> list[int]:
        return [p + q for p, q in zip(x, y, strict=True)]

    return added(a[0], b[0]), [added(x, y) for x, y in zip(a[1], b[1], strict=True)], added(a[2], b[2])


def _matrices(batches: Iterator[pa.RecordBatch], dim: int) -> Iterator[tuple[pa.Array, np.ndarray]]:
    for batch in batches:
        for i in range(0, batch.num_rows, BLOCK):
            part = batch.slice(i, BLOCK)
            yield part.column(0), integers(part.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, dim))


def totals(points: DataFrame, centroids: list[list[int]], dim: int) -> Totals | None:
    """Counts, component sums and sums of distances of the centroids' vectors."""
    clusters = len(centroids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Totals | None = None
        for _, x in _matrices(batches, dim):
            found = distances(x, centroids)
            cluster = found.argmin(axis=1)
            nearest = found[np.arange(len(x)), cluster]
            far = [sum(nearest[cluster == i].tolist()) for i in range(clusters)]
            total = merged(total, (np.bincount(cluster, minlength=clusters).tolist(), sums_by(x, cluster, clusters), far))
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(total)], pa.binary())], names=["totals"])

    parts = points.mapInArrow(run, "totals binary").rdd
    return parts.treeAggregate(None, lambda a, row: merged(a, pickle.loads(bytes(row["totals"]))), merged)


def first_centroids(points: DataFrame, clusters: int, seed: int) -> list[list[int]]:
    """The vectors whose SHA-256 of ``seed:vec_id`` is smallest, in that order."""
    name = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    chosen = points.orderBy(F.asc_nulls_last(name), "x").limit(clusters).collect()
    return [[int(v) for v in integers(np.array(r["x"], dtype=np.float64)).tolist()] for r in chosen]


def moved(centroids: list[list[int]], total: Totals | None) -> list[list[int]]:
    """Each centroid at the floor of its vectors' mean; one without vectors stays."""
    if total is None:
        return centroids
    counts, sums, _ = total
    return [[s // n for s in own] if n else old for old, n, own in zip(centroids, counts, sums, strict=True)]


def _long(value: int) -> int | None:
    return value if value < EXACT_LONG else None


def clustering(vectors: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, dim: int = DIM, seed: int = 1) -> tuple[DataFrame, DataFrame]:
    """Vectors (vec_id, cluster, distance), and the final centroids.

    Centroids: cluster, n, cluster_inertia, inertia, centroid (components as decimal
    integers), a row each.  ``vectors``: vec_id, embedding.  Every round reads the kept
    vectors once.
    """
    spark = vectors.sparkSession
    points = cut(usable(vectors, dim), "points")
    centroids = first_centroids(points, clusters, seed)
    for _ in range(rounds if centroids else 0):
        centroids = moved(centroids, totals(points, centroids, dim))
    counts, _, far = (totals(points, centroids, dim) if centroids else None) or ([], [], [])
    rows = [(i, n, _long(d), _long(sum(far)), [str(v) for v in c]) for i, (n, d, c) in enumerate(zip(counts, far, centroids, strict=True))]
    final = spark.createDataFrame(rows, "cluster int, n long, cluster_inertia long, inertia long, centroid array<string>")
    schema = pa.schema([("vec_id", pa.int64()), ("cluster", pa.int32()), ("distance", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, x in _matrices(batches, dim):
            found = distances(x, centroids)
            own = found.argmin(axis=1)
            nearest = [_long(int(v)) for v in found[np.arange(len(x)), own].tolist()]
            yield pa.RecordBatch.from_arrays([ids, pa.array(own, pa.int32()), pa.array(nearest, pa.int64())], schema=schema)

    return points.mapInArrow(run, "vec_id long, cluster int, distance long"), final


def cluster(vectors: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, dim: int = DIM, seed: int = 1) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid: a row per vector that is kept."""
    assigned, final = clustering(vectors, clusters, rounds, dim, seed)
    return assigned.join(F.broadcast(final.drop("n")), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid")
