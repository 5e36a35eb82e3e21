"""Near-duplicate embeddings by cosine within cells (operator 13).

Vectors of one label (and of one length) whose cosine is at least ``SIMILARITY`` are
linked; a component of links is a group, and the row with its smallest vec_id stays.

Method: spherical k-means assigns the vectors to cells, and blocked matrix products of
unit vectors compare within cells.  The centroids are fitted on a bounded sample
(``SAMPLE`` vectors, expected, chosen by a hash); every vector is assigned.  No link is lost
between cells: the middle of two linked vectors lies in some cell, and each of the two is
within half the link's widest angle of it.  A vector therefore goes to its own cell and
to every cell to whose side of the dividing plane it is as near as that (six to ten
cells on the given vectors, of 50 to 400); a pair that meets in several counts in the
first.  Recall is 1 by construction, whatever the centroids are; these decide the work
only.

Equal vectors of one label are one class, told apart by 128 bits of hashes and counted
on the map side, so copies cost nothing.  Cells are dealt into tiles of some ``TILE``
classes; pairs of tiles are rows of bounded size, so a dense cell spreads over tasks.
A task passes on sums of links by class and a spanning forest of what it has linked,
never all pairs; components are then found by rounds of joins.  The number of cells
grows with the number of classes up to ``MAX_CELLS``, which is what is broadcast.

Vectors that are null, empty, zero or hold a null or non-finite component, and those
with a null label, link with nothing.  Lengths differ: no link.  Repeated rows and ids
are vectors of their own; with one id they are kept or not together.  A null vec_id
never names a component unless all its members' are null (then null, and all are kept).
Components of any magnitude do: vectors are scaled before they are squared.  An
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, record_batch, small_batches
from .components import connected_components
from .simhash import Forest

SIMILARITY = 0.98
#: Classes that a cell holds on average, cells altogether, and vectors they are fitted on.
CELL, MAX_CELLS, SAMPLE, ROUNDS = 1024, 16_384, 65_536, 6
#: Classes in a tile, and rows of a matrix product.
TILE, STRIP = 512, 256
#: Links in a task's forest before it is passed on.
FOREST = 500_000


def units(x: np.ndarray) -> np.ndarray:
    """Rows of length one."""
    scaled = x / np.abs(x).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def vector_classes(vectors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows (vec_id, a, b: the class, or null) and classes (node, a, b, label, x, n, rep)."""
    x = vectors["embedding"].cast("array<double>")
    good = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != F.lit(float("inf")))) & F.exists(x, lambda v: v != 0)
    usable = F.coalesce(good & vectors["label"].isNotNull(), F.lit(False))
    given = vectors.select(vectors["vec_id"].cast("long").alias("vec_id"), vectors["label"].alias("label"), F.when(usable, x).alias("x"))
    seen = F.col("x").isNotNull()
    rows = cut(given.select("vec_id", F.when(seen, F.xxhash64("label", "x")).alias("a"), F.when(seen, F.xxhash64(F.lit(1), "label", "x")).alias("b"), "label", "x"), "rows")
    held = rows.filter("a is not null").groupBy("a", "b").agg(F.first("label").alias("label"), F.first("x").alias("x"), F.count(F.lit(1)).alias("n"), F.min("vec_id").alias("rep"))
    # Numbered as they are written, so a class keeps its number.
    classes = cut(held.withColumn("node", F.monotonically_increasing_id()), "classes")
    return rows.select("vec_id", "a", "b"), classes


def spherical_means(sample: np.ndarray, cells: int, rounds: int = ROUNDS) -> np.ndarray:
    """Unit centroids of the rows of ``sample`` (units); the first rows are the first centroids."""
    means = sample[:cells].copy()
    for _ in range(rounds):
        own = np.concatenate([(sample[i : i + 4096] @ means.T).argmax(axis=1) for i in range(0, len(sample), 4096)])
        order = np.argsort(own, kind="stable")
        found, starts = np.unique(own[order], return_index=True)
        sums = np.add.reduceat(sample[order], starts, axis=0)
        length = np.sqrt((sums * sums).sum(axis=1))
        whole = length > 1e-12  # opposite vectors may cancel out
        means[found[whole]] = sums[whole] / length[whole, None]
    return means


def fit_cells(classes: DataFrame, cell: int = CELL) -> dict[int, np.ndarray]:
    """Centroids by length of the vectors, for lengths with more than one cell's worth."""
    lengths = classes.groupBy(F.size("x").alias("dim")).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > cell).collect()
    total = sum(r["n"] for r in lengths)
    if not total:
        return {}
    cells = {r["dim"]: max(1, int(r["n"] / max(cell, total / MAX_CELLS))) for r in lengths}
    share = min(1.0, SAMPLE / total)
    chosen = F.pmod(F.xxhash64("a", "b"), F.lit(1 << 30)) < F.lit(int(share * (1 << 30)))
    sample = classes.select(F.size("x").alias("dim"), "a", "b", "x").filter(chosen & F.col("dim").isin(list(cells)))

    def fit(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["a", "b"])
        dim = int(rows["dim"].iloc[0])
        means = spherical_means(units(np.stack(rows["x"].to_numpy())), cells[dim])
        return pd.DataFrame({"dim": dim, "c": list(means)})

    made: dict[int, list] = {}
    for r in sample.groupBy("dim").applyInPandas(fit, "dim int, c array<double>").collect():
        made.setdefault(r["dim"], []).append(r["c"])
    return {dim: np.array(c) for dim, c in made.items()}


def cells_of(unit: np.ndarray, means: np.ndarray, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """Rows and cells of all places: of each row, its nearest cell and those near enough for a link's middle."""
    near = unit @ means.T
    home = near.argmax(axis=1)
    apart = np.sqrt(np.maximum(0.0, 2.0 - 2.0 * np.clip(means[home] @ means.T, -1.0, 1.0)))
    gap = near[np.arange(len(unit)), home][:, None] - near
    # A little wider than needed, so that rounding never parts linked vectors.
    reach = (math.sqrt((1.0 - similarity) / 2.0) + 1e-9) * apart + 1e-9
    return np.nonzero(gap <= reach)


def placed(classes: DataFrame, means: dict[int, np.ndarray], similarity: float) -> DataFrame:
    """label, dim, cell, node, n, unit, cells: each class in each of its ``cells``."""
    label = classes.schema["label"].dataType
    sent = classes.sparkSession.sparkContext.broadcast(means)
    names = ["label", "dim", "cell", "node", "n", "unit", "cells"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.diff(batch.column(3).offsets.to_numpy())
            for dim in np.unique(sizes).tolist():
                part = batch.take(pa.array(np.flatnonzero(sizes == dim)))
                unit = units(part.column(3).flatten().to_numpy(zero_copy_only=False).reshape(-1, dim))
                for i in range(0, len(unit), STRIP):
                    own = unit[i : i + STRIP]
                    at, cells = cells_of(own, sent.value[dim], similarity) if dim in sent.value else (np.arange(len(own)), np.zeros(len(own), dtype=np.int64))
                    held = part.slice(i, STRIP).take(pa.array(at))
                    vectors = pa.ListArray.from_arrays(pa.array(np.arange(len(at) + 1) * dim, pa.int32()), pa.array(own[at].ravel()))
                    ends = np.searchsorted(at, np.arange(len(own) + 1))
                    lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(cells, pa.int32())).take(pa.array(at))
                    columns = [held.column(0), pa.array(np.full(len(at), dim), pa.int32()), pa.array(cells, pa.int32()), held.column(1), held.column(2), vectors, lists]
                    yield pa.RecordBatch.from_arrays(columns, names=names)

    given = classes.select("label", "node", "n", "x")
    return given.mapInArrow(run, f"label {label.simpleString()}, dim int, cell int, node long, n long, unit array<double>, cells array<int>")


class Side:
    """A tile: its classes' numbers, how many vectors they stand for, unit vectors and cells."""

    def __init__(self, rows: pa.StructArray, dim: int):
        self.nodes, counts = (rows.field(c).to_numpy() for c in ("node", "n"))
        self.counts = counts.astype(np.float64)
        self.unit = rows.field("unit").flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
        cells = rows.field("cells")
        self.cells, self.owners = cells.flatten().to_numpy(), np.repeat(np.arange(len(self.nodes)), cells.value_lengths().to_numpy())

    def before(self, cell: int) -> np.ndarray:
        """The cells of its classes that come before ``cell``."""
        return np.unique(self.cells[self.cells < cell])

    def member(self, cells: np.ndarray) -> np.ndarray:
        """Which class is in which of ``cells`` (in order), as a matrix."""
        out = np.zeros((len(self.nodes), len(cells)), dtype=np.float32)
        place = np.searchsorted(cells, self.cells).clip(max=len(cells) - 1)
        there = cells[place] == self.cells
        out[self.owners[there], place[there]] = 1.0
        return out


def tile_pairs(homes: DataFrame, tile: int) -> DataFrame:
    """dim, cell, same, left, right: all pairs of tiles of a cell.

    ``homes``: what ``placed`` gives.  Which tiles meet is settled on their names, and
    every tile is a join key of its own.
    """
    key = ["label", "dim", "cell"]
    sized = cut(homes.groupBy(*key).agg(F.ceil(F.count(F.lit(1)) / F.lit(tile)).cast("int").alias("n_tiles")), "sized")
    dealt = homes.join(sized, key).withColumn("tile", F.pmod(F.xxhash64("node"), F.col("n_tiles")).cast("int"))
    tiles = cut(dealt.groupBy(*key, "tile").agg(F.collect_list(F.struct("node", "n", "unit", "cells")).alias("rows")), "tiles")
    numbers = sized.select(*key, F.explode(F.sequence(F.lit(0), F.col("n_tiles") - 1)).alias("tile"))
    met = tiles.select(*key, F.col("tile").alias("left_tile")).join(numbers, key).filter(F.col("left_tile") <= F.col("tile"))
    lefts = tiles.select(*key, F.col("tile").alias("left_tile"), F.col("rows").alias("left"))
    rights = tiles.select(*key, "tile", F.col("rows").alias("right"))
    same = F.col("left_tile") == F.col("tile")
    return met.join(lefts, [*key, "left_tile"]).join(rights, [*key, "tile"]).select("dim", "cell", same.alias("same"), "left", "right")


def linked(pairs: DataFrame, similarity: float) -> DataFrame:
    """u, v, links: rows with v are edges of a spanning forest, rows without it say how many vectors a class is linked to."""
    schema = pa.schema([("u", pa.int64()), ("v", pa.int64()), ("links", pa.int64())])

    def made(found: list[tuple[int, int]]) -> pa.RecordBatch:
        return record_batch({"u": [x[0] for x in found], "v": [x[1] for x in found], "links": [None] * len(found)}, schema)

    def counted(nodes: np.ndarray, links: np.ndarray) -> pa.RecordBatch:
        some = links > 0
        own = pa.array(nodes[some])
        return pa.RecordBatch.from_arrays([own, pa.nulls(len(own), pa.int64()), pa.array(links[some].astype(np.int64))], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest, found = Forest(), []
        for batch in batches:
            for i in range(batch.num_rows):
                dim, cell, same = (batch.column(c)[i].as_py() for c in range(3))
                left, right = (Side(batch.column(c)[i].values, dim) for c in (3, 4))
                shared = np.intersect1d(left.before(cell), right.before(cell))
                members = (left.member(shared), right.member(shared)) if len(shared) else None
                of_left, of_right = np.zeros(len(left.nodes)), np.zeros(len(right.nodes))
                for at in range(0, len(left.nodes), STRIP):
                    near = left.unit[at : at + STRIP] @ right.unit.T >= similarity
                    if same:
                        near &= np.arange(len(right.nodes))[None, :] > np.arange(at, at + len(near))[:, None]
                    if members and near.any():
                        near &= members[0][at : at + STRIP] @ members[1].T == 0
                    a, b = np.nonzero(near)
                    if not len(a):
                        continue
                    of_left[at : at + STRIP] += near @ right.counts
                    of_right += left.counts[at : at + STRIP] @ near
                    found += forest.link_all(left.nodes, right.nodes, a + at, b)
                yield counted(left.nodes, of_left)
                yield counted(right.nodes, of_right)
            if len(found) > FOREST:
                yield made(found)
                forest, found = Forest(), []
        yield made(found)

    return pairs.mapInArrow(run, "u long, v long, links long")


def near_duplicate_vectors(vectors: DataFrame, similarity: float = SIMILARITY, cell: int = CELL, tile: int = TILE) -> DataFrame:
    """vec_id, n_links (other vectors linked directly), component_id, kept: a row per row of ``vectors``.

    ``vectors``: vec_id, embedding, label.  ``similarity``: above 0.  component_id is the
    smallest vec_id that links reach.
    """
    small_batches(vectors.sparkSession)
    rows, classes = vector_classes(vectors)
    homes = cut(placed(classes, fit_cells(classes, cell), similarity), "homes")
    links = cut(linked(tile_pairs(homes, tile), similarity), "links")
    counts = links.filter("v is null").groupBy(F.col("u").alias("node")).agg(F.sum("links").alias("links"))
    roots = connected_components(links.filter("v is not null").select("u", "v")).withColumnRenamed("node", "own")
    named = classes.select("a", "b", "node", "n", "rep").join(counts, "node", "left")
    rooted = cut(named.join(roots, named["node"] == roots["own"], "left").select("a", "b", "rep", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("root", "node").alias("root")), "rooted")
    firsts = cut(rooted.groupBy("root").agg(F.min("rep").alias("component_id")), "firsts")
    known = cut(rooted.join(firsts, "root").select("a", "b", "n_links", "component_id"), "known")
    # Tables on both sides, so the join can be split where a vector has very many copies.
    found = rows.filter("a is not null").join(known, ["a", "b"]).select("vec_id", "n_links", "component_id")
    alone = rows.filter("a is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return found.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
