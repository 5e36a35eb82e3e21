"""A property graph in tables: contexts, topics, code entities, sessions and edges."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as tf
from ..functions import vectors as vf
from ..session import written
from .places import ranked

#: Query vectors, and vectors, that are compared as one matrix.
QUERY_BLOCK, VECTOR_BLOCK = 1024, 4096


def upsert(rows: DataFrame, key: list[str], order: list[str], first: list[str], last: list[str]) -> DataFrame:
    """One row for each key: ``first`` columns of its earliest row, ``last`` of its latest."""
    at = F.struct(*order)
    return rows.groupBy(*key).agg(
        *[F.min_by(c, at).alias(c) for c in first], *[F.max_by(c, at).alias(c) for c in last]
    )


def violations(rows: DataFrame, key: list[str]) -> DataFrame:
    """Keys that occur more than once; empty where the key is unique."""
    return rows.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def link(pairs: DataFrame, left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct edges (src, dst) whose ends both exist, as columns ``id``."""
    known = pairs.join(left.select(F.col("id").alias("src")), "src", "left_semi")
    return known.join(right.select(F.col("id").alias("dst")), "dst", "left_semi").select("src", "dst").distinct()


def follows(contexts: DataFrame, session: str = "session_id", at: str = "timestamp") -> DataFrame:
    """Edges from each context to the one before it in its session."""
    before = F.lag("id").over(Window.partitionBy(session).orderBy(at, "id"))
    return contexts.select(F.col("id").alias("src"), before.alias("dst")).filter("dst is not null")


def follows_by_ranges(contexts: DataFrame, session: str = "session_id", at: str = "timestamp") -> DataFrame:
    """As ``follows``, for sessions of which one may be longer than a task can sort.

    All contexts are sorted by ranges and numbered, and each meets the number before its own.
    """
    places = ranked(contexts.select(F.col(session).alias("session"), F.col(at).alias("time"), "id"), ["session", "time", "id"], "at")
    before = places.select((F.col("at") + 1).alias("at"), F.col("session").alias("before"), F.col("id").alias("dst"))
    met = places.select("at", "session", F.col("id").alias("src")).join(before, "at")
    return met.filter(F.col("session").eqNullSafe(F.col("before"))).select("src", "dst")


def chains(edges: DataFrame) -> DataFrame:
    """start, end, steps, least: how far the edges (src, dst) lead from each src, and the least node on the way.

    A node has at most one edge that leaves it; rows that say the same twice do no harm.
    By pointer doubling: in every round a node takes over what the node it points to
    knows, so a chain of n nodes is walked in log2(n) rounds, each a join of the nodes
    that are not at their end yet.  Nodes that are there are not written again.  A
    cycle, or a node with two edges, is an error; edges with a null end are left out.
    """
    known = edges.filter("src is not null and dst is not null").select("src", "dst").distinct()
    if known.groupBy("src").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").limit(1).count():
        raise ValueError("a node has more than one edge that leaves it")
    ways = known.select(F.col("src").alias("start"), F.col("dst").alias("end"), F.lit(1).cast("long").alias("steps"), F.least("src", "dst").alias("least"))
    further = known.select(F.col("src").alias("end"), F.lit(True).alias("goes_on"))
    active = written(ways.join(further, "end", "left").withColumn("done", F.col("goes_on").isNull()).drop("goes_on"), "chains")
    columns = ["start", "end", "steps", "least", "done"]
    ended, left = [active.filter("done").select(*columns)], active.filter("not done").select(*columns)
    n = left.count()
    # Each round doubles the steps, so no chain of the nodes that are there needs more.
    for _ in range(n.bit_length() + 1):
        if not n:
            break
        every = left
        for part in ended:
            every = every.unionByName(part)
        ahead = every.select(F.col("start").alias("via"), F.col("end").alias("to"), F.col("steps").alias("more"), F.col("least").alias("lowest"), F.col("done").alias("there"))
        met = left.join(ahead, left["end"] == ahead["via"]).select(
            "start", F.col("to").alias("end"), (F.col("steps") + F.col("more")).alias("steps"), F.least("least", "lowest").alias("least"), F.col("there").alias("done")
        )
        now = written(met, "chains")
        ended.append(now.filter("done"))
        left = now.filter("not done")
        n = left.count()
    if n:
        raise ValueError("the edges have a cycle")
    every = ended[0]
    for part in ended[1:]:
        every = every.unionByName(part)
    return every.drop("done")


def session_history(contexts: DataFrame, session_id: object) -> DataFrame:
    return contexts.filter(F.col("session_id") == session_id).orderBy("timestamp", "id")


def latest_in_session(contexts: DataFrame, session: str = "session_id") -> DataFrame:
    return contexts.groupBy(session).agg(F.max_by("id", F.struct("timestamp", "id")).alias("id"))


def contexts_linked_to(contexts: DataFrame, edges: DataFrame, nodes: DataFrame, wanted: Column) -> DataFrame:
    """Contexts with an edge to a node that fits ``wanted``, newest first."""
    hits = edges.join(nodes.filter(wanted).select(F.col("id").alias("dst")), "dst").select(F.col("src").alias("id")).distinct()
    return contexts.join(hits, "id", "left_semi").orderBy(F.desc("timestamp"), "id")


def topic_counts(topic_nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Every topic with its number of contexts, zero included."""
    counts = edges.groupBy("dst").agg(F.count("src").alias("n"))
    return topic_nodes.join(counts, topic_nodes["id"] == counts["dst"], "left").select(
        "name", "description", F.coalesce("n", F.lit(0)).alias("context_count")
    )


def neighbours(contexts: DataFrame, kinds: dict[str, tuple[DataFrame, DataFrame, str]]) -> DataFrame:
    """``contexts`` with a sorted array of neighbours for each kind.

    ``kinds``: name of the array to (edges, nodes, column of the nodes).  Each kind is
    aggregated before it is joined, so the kinds never multiply each other.
    """
    out = contexts
    for name, (edges, nodes, column) in kinds.items():
        listed = (
            edges.join(nodes.select(F.col("id").alias("dst"), F.col(column).alias("__v")), "dst")
            .groupBy(F.col("src").alias("id"))
            .agg(F.sort_array(F.collect_set("__v")).alias(name))
        )
        out = out.join(listed, "id", "left").withColumn(name, F.coalesce(name, F.array().cast("array<string>")))
    return out


def delete_nodes(nodes: DataFrame, edges: DataFrame, gone: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes and edges without those that ``gone`` (id) names."""
    left = nodes.join(gone, "id", "left_anti")
    by_src = edges.join(gone.select(F.col("id").alias("src")), "src", "left_anti")
    return left, by_src.join(gone.select(F.col("id").alias("dst")), "dst", "left_anti").select("src", "dst")


def nearest(vectors: DataFrame, query: list[float], k: int = 10, key: str = "id", vector: str = "embedding") -> DataFrame:
    """key, score of the ``k`` most similar vectors; ties by key.  Exact.

    Vectors that have no similarity (zero, null, of another length) are left out; none
    is similar to a zero query.
    """
    q = F.array(*[F.lit(float(x)) for x in query])
    scored = vectors.select(key, vf.cosine(F.col(vector), q).alias("score")).filter("score is not null")
    return scored.orderBy(F.desc("score"), key).limit(k or 10)


def _blocks(rows: DataFrame, key: str, vector: str, size: int, name: str) -> DataFrame:
    """dim, <name>, rows: vectors of one length in blocks of some ``size``, as arrays of (id, v)."""
    usable = rows.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"))
    usable = usable.filter("id is not null and v is not null").withColumn("norm", vf.norm(F.col("v"))).filter("norm > 0")
    n = max(1, -(-usable.count() // size))
    unit = F.transform("v", lambda x: x / F.col("norm")).alias("v")
    dealt = usable.select(F.size("v").alias("dim"), F.pmod(F.xxhash64("id"), F.lit(n)).cast("int").alias(name), F.struct("id", unit).alias("x"))
    return dealt.groupBy("dim", name).agg(F.collect_list("x").alias(f"{name}_rows"))


def nearest_batch(
    vectors: DataFrame, queries: DataFrame, k: int = 10, key: str = "id", vector: str = "embedding"
) -> DataFrame:
    """query_id, id, score, rank for every query: blocks of queries against blocks of vectors.

    Both tables are read once, whatever the number of queries.  Blocks of vectors and of
    queries meet as matrices; of each pair of blocks the best ``k`` of a query go on, and
    only those meet.  A query is left out of its own answers; ties go by id.  Vectors
    that are zero, null or of another length have no similarity and no rank.
    """
    asked = _blocks(queries, key, vector, QUERY_BLOCK, "q")
    given = _blocks(vectors, key, vector, VECTOR_BLOCK, "b")
    numbers = given.groupBy("dim").agg(F.collect_set("b").alias("bs"))
    pairs = given.join(asked.join(numbers, "dim").select("dim", F.explode("bs").alias("b"), "q_rows"), ["dim", "b"])
    schema = pa.schema([("query_id", pa.int64()), ("id", pa.int64()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for q_rows, b_rows in zip(batch.column(0), batch.column(1), strict=True):
                (ids, asked_for), (own, known) = (_matrix(x.values) for x in (q_rows, b_rows))
                scores = asked_for @ known.T
                scores[ids[:, None] == own[None, :]] = -np.inf
                if scores.shape[1] > k:
                    least = -np.partition(-scores, k - 1, axis=1)[:, k - 1 : k]
                else:
                    least = np.full((len(ids), 1), -2.0)
                rows, columns = np.nonzero((scores >= least) & (scores > -2))
                order = np.lexsort((own[columns], -scores[rows, columns], rows))
                rows, columns = rows[order], columns[order]
                place = np.arange(len(rows)) - np.searchsorted(rows, rows)
                rows, columns = rows[place < k], columns[place < k]
                yield pa.RecordBatch.from_arrays([pa.array(ids[rows]), pa.array(own[columns]), pa.array(scores[rows, columns])], schema=schema)

    found = pairs.select("q_rows", "b_rows").mapInArrow(run, "query_id long, id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k)


def _matrix(rows: pa.StructArray) -> tuple[np.ndarray, np.ndarray]:
    ids = rows.field("id").to_numpy()
    return ids, rows.field("v").flatten().to_numpy(zero_copy_only=False).reshape(len(ids), -1)


def search(contexts: DataFrame, query: list[float], kinds: dict, k: int = 10, least: float = 0.75) -> DataFrame:
    """Top ``k`` first, then those of at least ``least`` with their neighbours, best first."""
    hits = nearest(contexts, query, k).filter(F.col("score") >= least)
    found = neighbours(contexts.join(hits, "id"), kinds)
    return found.orderBy(F.desc("score"), "id")


def rows_of(inputs: DataFrame) -> dict[str, DataFrame]:
    """What new contexts say of each node and edge table, not merged yet.

    ``inputs``: id, summary, full_text, session_id, project, timestamp, embedding and
    topics (array of names).  Edges go by natural keys: a topic's name, and an entity's
    (file_path, name), so a second context that names a known topic is linked to it.
    """
    contexts = inputs.select(
        "id", "summary", "full_text", "timestamp", "session_id", tf.token_count(F.col("full_text")).alias("token_count"), "embedding"
    )
    named = inputs.select("id", "timestamp", F.explode("topics").alias("name"))
    entities = inputs.select("id", "timestamp", F.explode(tf.code_entities(F.col("full_text"))).alias("e")).select(
        "id", "timestamp", "e.*", F.concat_ws("\x1f", "e.file_path", "e.name").alias("entity")
    )
    return {
        "contexts": contexts,
        "sessions": inputs.select("session_id", "project", F.col("timestamp").alias("start_time"), "timestamp", "id"),
        "topics": named.select(F.col("name").alias("id"), "name"),
        "entities": entities.select("entity", "file_path", "name", "entity_type", "timestamp", F.col("id").alias("src")),
        "belongs_to": contexts.select(F.col("id").alias("src"), F.col("session_id").alias("dst")),
        "contains_topic": named.select(F.col("id").alias("src"), F.col("name").alias("dst")),
        "references_code": entities.select(F.col("id").alias("src"), F.col("entity").alias("dst")),
    }


def ingest(inputs: DataFrame) -> dict[str, DataFrame]:
    """Node and edge tables of new contexts: one plan for any number of them."""
    rows = rows_of(inputs)
    return rows | {
        "sessions": upsert(rows["sessions"], ["session_id"], ["timestamp", "id"], ["project", "start_time"], []),
        "topics": rows["topics"].distinct(),
        "entities": upsert(rows["entities"], ["entity", "file_path", "name"], ["timestamp", "src"], [], ["entity_type"]),
        "follows": follows(rows["contexts"]),
        "contains_topic": rows["contains_topic"].distinct(),
        "references_code": rows["references_code"].distinct(),
    }
