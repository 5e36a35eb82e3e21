"""The context store as one object: batches in, tables or JSON out.

Node and edge tables are stored tables that a batch is merged into by key, so a write
rewrites the buckets that it touches and a read is a scan.  A batch that is stored
again replaces its own rows.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import token_count
from ..operators import graph, topics, vector_index
from ..sources.files import exists
from .stored import Kind, StoredTables

INPUT = (
    "id string, summary string, full_text string, session_id string, project string, timestamp timestamp, "
    "embedding array<float>, topics array<string>"
)

EDGE = Kind(("src", "dst"), "src string, dst string", by=("src",))
_BEFORE = "lag(id) OVER (PARTITION BY session_id ORDER BY timestamp, id)"
#: A session's contexts share a bucket, so who follows whom is settled where they are merged.
KINDS = {
    "contexts": Kind(
        ("session_id", "id"), "id string, summary string, full_text string, timestamp timestamp, session_id string, token_count int, embedding array<float>",
        ("timestamp",), (), ("summary", "full_text", "timestamp", "token_count", "embedding"), ("session_id",), {"previous": _BEFORE},
    ),
    "sessions": Kind(("session_id",), "session_id string, project string, start_time timestamp, timestamp timestamp, id string", ("timestamp", "id"), ("project", "start_time")),
    "topics": Kind(("id", "name"), "id string, name string", by=("name",)),
    "entities": Kind(
        ("entity", "file_path", "name"), "entity string, file_path string, name string, entity_type string, timestamp timestamp, src string",
        ("timestamp", "src"), (), ("entity_type",), ("file_path",),
    ),
    "belongs_to": EDGE, "contains_topic": EDGE, "references_code": EDGE,
}
#: Vector indexes: the table and column of each.
INDEXES = {"context_embedding": ("contexts", "embedding")}

#: Rows of a page that comes to the driver as JSON.
PAGE = 1000


class ContextStore:
    """``encode`` turns texts into vectors; ``now`` gives the time of a write."""

    def __init__(self, spark: SparkSession, root: str, encode: Callable[[list[str]], list], now: Callable[[], object], project: str = "default", top_topics: int = 5):
        self.spark, self.root, self.encode, self.now = spark, root.rstrip("/"), encode, now
        self.project, self.top_topics = project, top_topics
        self.stored = StoredTables(spark, self.root, KINDS)

    def init_schema(self) -> None:
        """An empty snapshot, if there is none."""
        if not self.stored.versions():
            self.stored.merge({})

    def tables(self) -> dict[str, DataFrame]:
        """Node and edge tables of all that is stored, as of one snapshot."""
        version, _ = self.stored.snapshot()
        made = {name: self.stored.read(name, version) for name in KINDS}
        contexts = made["contexts"]
        follows = contexts.filter("previous is not null").select(F.col("id").alias("src"), F.col("previous").alias("dst"))
        return made | {"contexts": contexts.drop("previous"), "follows": follows}

    def build_indexes(self, dim: int | None = None, **how: object) -> None:
        """Vector indexes of all that is stored now; those that are there are replaced."""
        made, (version, _) = self.tables(), self.stored.snapshot()
        for name, (table, column) in INDEXES.items():
            vector_index.build_index(made[table], f"{self.root}/indexes/{name}", name, vector=column, dim=dim, **how)
            self.spark.createDataFrame([(version,)], "version long").coalesce(1).write.mode("overwrite").json(f"{self.root}/indexes/{name}/version")

    def indexes(self) -> DataFrame:
        """The vector indexes with their state: ONLINE, or STALE if something was stored since."""
        there = [name for name in INDEXES if exists(self.spark, f"{self.root}/indexes/{name}/version")]
        found, (now, _) = vector_index.list_indexes(self.spark, [f"{self.root}/indexes/{name}" for name in there]), self.stored.snapshot()
        old = [n for n in there if self.spark.read.schema("version long").json(f"{self.root}/indexes/{n}/version").first()["version"] < now]
        return found.withColumn("state", F.when(F.col("name").isin(old), "STALE").otherwise(F.col("state")))

    def violations(self) -> dict[str, DataFrame]:
        """Keys that occur more than once in a table where they must not."""
        made = self.tables()
        keys = {"contexts": ["id"], "sessions": ["session_id"], "topics": ["name"], "entities": ["file_path", "name"]}
        return {name: graph.violations(made[name], key) for name, key in keys.items()}

    def store_batch(self, inputs: DataFrame) -> int:
        """Merge contexts in the form of INPUT; the number of the snapshot that holds them."""
        return self.stored.merge(graph.rows_of(inputs.select(*[c.split()[0] for c in INPUT.split(", ")])))

    def store_context(self, summary: str, full_text: str, session_id: str, project: str | None = None) -> str:
        """Store one context with its frequent words as topics; a JSON text of what was found."""
        at = self.now()
        row = self.spark.createDataFrame(
            [(summary, full_text, session_id, project or self.project, at)],
            "summary string, full_text string, session_id string, project string, timestamp timestamp",
        ).withColumn("id", F.md5(F.concat_ws("|", "session_id", F.col("timestamp").cast("string"), "full_text")))
        vector = [float(x) for x in self.encode([summary])[0]]
        named = topics.topics(row, "id", "full_text", self.top_topics)
        listed = named.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("rank", "name"))).alias("t"))
        ready = row.join(listed, "id", "left").select(
            "*", F.array(*[F.lit(x) for x in vector]).cast("array<float>").alias("embedding"),
            F.coalesce(F.transform("t", lambda t: t["name"]), F.array().cast("array<string>")).alias("topics"),
        )
        found = ready.select("id", "topics", token_count(F.col("full_text")).alias("n")).first()
        self.store_batch(ready)
        refs = graph.ingest(ready)["references_code"].collect()
        names = sorted({p or n for p, n in (r["dst"].split("\x1f") for r in refs)})
        return json.dumps({"context_id": found["id"], "topics_extracted": list(found["topics"]), "code_refs_found": names, "token_count": found["n"]})

    def nearest(self, query: str, top_k: int = 10, exact: bool = True) -> DataFrame:
        """id, score of the contexts most like the query by their index, which must be ONLINE."""
        asked = self.spark.createDataFrame([("", [float(x) for x in self.encode([query])[0]])], "id string, embedding array<double>")
        return vector_index.search_index(self.spark, f"{self.root}/indexes/context_embedding", asked, top_k, exact=exact).select("id", "score")

    def search_contexts(self, query: str, top_k: int = 10, least: float = 0.75) -> str:
        made = self.tables()
        names = made["topics"].select("id", "name")
        files = made["entities"].select(F.col("entity").alias("id"), "file_path")
        kinds = {"topics": (made["contains_topic"], names, "name"), "code_refs": (made["references_code"], files, "file_path")}
        hits = graph.search(made["contexts"], self.encode([query])[0], kinds, top_k, least)
        shown = hits.select(
            F.col("id").alias("context_id"), "summary", "full_text", F.col("timestamp").cast("string").alias("timestamp"),
            "token_count", F.col("score").alias("similarity_score"), "topics", "code_refs",
        )
        return _json(shown, top_k, 0)

    def topic_contexts(self, topic_name: str) -> DataFrame:
        made = self.tables()
        return graph.contexts_linked_to(made["contexts"], made["contains_topic"], made["topics"], F.col("name") == topic_name).drop("embedding")

    def file_history(self, file_path: str) -> DataFrame:
        made = self.tables()
        nodes = made["entities"].select(F.col("entity").alias("id"), "file_path")
        return graph.contexts_linked_to(made["contexts"], made["references_code"], nodes, F.col("file_path") == file_path).drop("embedding")

    def session_history(self, session_id: str) -> DataFrame:
        """One bucket is read."""
        return graph.session_history(self.stored.look_up("contexts", session_id=session_id), session_id).drop("embedding", "previous")

    def topics_with_counts(self) -> DataFrame:
        made = self.tables()
        nodes = made["topics"].withColumn("description", F.lit(""))
        return graph.topic_counts(nodes, made["contains_topic"]).orderBy(F.desc("context_count"), "name")

    # The same as JSON texts, a page of at most ``limit`` rows from the row ``skip`` on.

    def get_topic_contexts(self, topic_name: str, limit: int = PAGE, skip: int = 0) -> str:
        return _json(self.topic_contexts(topic_name), limit, skip)

    def get_file_history(self, file_path: str, limit: int = PAGE, skip: int = 0) -> str:
        return _json(self.file_history(file_path), limit, skip)

    def get_session_history(self, session_id: str, limit: int = PAGE, skip: int = 0) -> str:
        return _json(self.session_history(session_id), limit, skip)

    def list_topics(self, limit: int = PAGE, skip: int = 0) -> str:
        return _json(self.topics_with_counts(), limit, skip)

    def execute(self, sql: str, **args: object) -> DataFrame:
        """SQL over the tables as views named ``store_<table>``."""
        for name, df in self.tables().items():
            df.createOrReplaceTempView(f"store_{name}")
        return self.spark.sql(sql, args=args or None)


def _json(rows: DataFrame, limit: int, skip: int) -> str:
    """A page of the rows, in their order, as a JSON list."""
    page = rows.offset(skip).limit(limit) if skip else rows.limit(limit)
    texts = page.select(F.to_json(F.struct(*rows.columns))).collect()
    return "[" + ", ".join(r[0] for r in texts) + "]"
