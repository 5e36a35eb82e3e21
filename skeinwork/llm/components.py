"""Connected components of an edge table by large-star and small-star rounds.

Every round is a few aggregations and joins over the edges; the edges are never
brought to the driver, only their number and a checksum.  The minimum over a
node's neighbours is an aggregate with partial sums on the map side, and the join
that hands it back can be split where one node has very many neighbours.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut

MAX_ROUNDS = 60


def _state(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").bitwiseAND(0xFFFFFFFF))).first()
    return row[0], row[1] or 0


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    return (
        both.join(least, "u")
        .filter(F.col("v") > F.col("u"))
        .select(F.col("v").alias("u"), F.least("u", "m").alias("v"))
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Edges point from u to a smaller v."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").filter(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges`` (u, v: two values of one orderable type) to (node, root).

    Root is the least node of the component.  Nodes without an edge to another
    node do not appear; edges with a null end are left out.  An empty edge table
    gives an empty result.
    """
    edges = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    edges = cut(edges.filter("u is not null and v is not null and u <> v").distinct(), "edges")
    state = _state(edges)
    for _ in range(MAX_ROUNDS):
        if not state[0]:
            break
        edges = cut(_small_star(_large_star(edges)), "edges")
        previous, state = state, _state(edges)
        if state == previous:
            break
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
