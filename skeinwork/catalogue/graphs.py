"""Queries of the context store.

Contexts: turns of ``conversations`` (session: conv_id, id: conv_id * 1000 + turn);
documents, their labels and sources serve as nodes and edges too.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as tf
from ..operators import graph, inference, topics, vector_index
from ..plans.context_store import ContextStore
from ..plans.stored import Kind, StoredTables
from .tables import scratch, table


def _contexts(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations")
    return c.select(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("id"), F.col("text").alias("full_text"),
        F.timestamp_seconds(F.col("turn") * 60).alias("timestamp"), F.col("conv_id").alias("session_id"), "role",
    )


def g1_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts that several documents share violate uniqueness."""
    docs = table(spark, sf_dir, "documents").select(F.md5("text").alias("digest"))
    return graph.violations(docs, ["digest"])


def g3_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select("user_id", "event_type", "event_id", "value", "ts")
    return graph.upsert(rows.withColumn("id", F.col("event_id")), ["user_id", "event_type"], ["ts", "event_id"], ["id"], ["value"])


G3 = """SELECT user_id, event_type, max(CASE WHEN a = 1 THEN event_id END) AS id, max(CASE WHEN z = 1 THEN value END) AS value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS a,
    row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS z FROM events) AS t GROUP BY user_id, event_type"""


def g4_follows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.follows(_contexts(spark, sf_dir))


def g4_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.latest_in_session(_contexts(spark, sf_dir))


def g5_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders' and line items' ends: customers in one segment, parts of one size or less."""
    pairs = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("src"), F.col("l_suppkey").alias("dst"))
    parts = table(spark, sf_dir, "part").filter("p_size <= 10").select(F.col("p_partkey").alias("id"))
    suppliers = table(spark, sf_dir, "supplier").filter("s_acctbal > 0").select(F.col("s_suppkey").alias("id"))
    return graph.link(pairs, parts, suppliers)


G5 = """SELECT DISTINCT l_partkey AS src, l_suppkey AS dst FROM lineitem
WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_size <= 10) AND l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0)"""


def _embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The vectors and a zero vector, which is similar to none."""
    zero = spark.sql("SELECT -1L AS vec_id, array_repeat(0f, 64) AS embedding, 0 AS label")
    return table(spark, sf_dir, "embeddings").unionByName(zero)


def _first_vector(spark: SparkSession, sf_dir: str) -> list[float]:
    return list(table(spark, sf_dir, "embeddings").orderBy("vec_id").select("embedding").first()[0])


def g6_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = graph.nearest(_embeddings(spark, sf_dir), _first_vector(spark, sf_dir), 10, "vec_id")
    return found.select("vec_id", F.round("score", 6).alias("score"))


def g6_topk_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector whose id 50 divides asks, and the zero vector; all answer."""
    e = _embeddings(spark, sf_dir)
    found = graph.nearest_batch(e, e.filter("vec_id % 50 = 0 or vec_id = -1"), 10, "vec_id")
    return found.select("query_id", "rank", F.round("score", 6).alias("score"))


COSINE = """list_sum(list_transform(range(1, len(a.embedding) + 1), lambda i: a.embedding[i]::DOUBLE * b.embedding[i]::DOUBLE))
  / sqrt(list_sum(list_transform(a.embedding, lambda x: x::DOUBLE * x::DOUBLE)) * list_sum(list_transform(b.embedding, lambda x: x::DOUBLE * x::DOUBLE)))"""
E = """e AS (SELECT * FROM (SELECT vec_id, embedding, label FROM embeddings UNION ALL SELECT -1, list_transform(range(64), lambda x: 0::FLOAT), 0) AS t
  WHERE list_sum(list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE)) > 0)"""
SIMILAR = f"{E}, s AS (SELECT b.vec_id, {COSINE} AS score FROM e a CROSS JOIN e b WHERE a.vec_id = (SELECT min(vec_id) FROM embeddings))"
G6B = f"""WITH {E} SELECT query_id, rank, score FROM (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS INT) AS rank, round(score, 6) AS score FROM (
  SELECT a.vec_id AS query_id, b.vec_id AS id, {COSINE} AS score FROM e a JOIN e b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0) AS t) AS u WHERE rank <= 10"""


def g6_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best 20 first, then those over the threshold, with their label's and place's neighbours."""
    e = _embeddings(spark, sf_dir).withColumnRenamed("vec_id", "id")
    labels = e.select(F.concat(F.lit("l"), F.col("label")).alias("id")).distinct().withColumn("name", F.col("id"))
    edges = e.select(F.col("id").alias("src"), F.concat(F.lit("l"), F.col("label")).alias("dst"))
    found = graph.search(e, _first_vector(spark, sf_dir), {"labels": (edges, labels, "name")}, 20, 0.3)
    return found.select("id", F.round("score", 6).alias("score"), F.array_join("labels", ",").alias("labels"))


G6T = f"""WITH {SIMILAR}, k AS (SELECT * FROM s ORDER BY score DESC, vec_id LIMIT 20)
SELECT k.vec_id AS id, round(score, 6) AS score, 'l' || label AS labels FROM k JOIN embeddings e ON e.vec_id = k.vec_id WHERE score >= 0.3"""


def _nation_graph(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, dict]:
    nations = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("id"), "n_name", F.col("n_regionkey").alias("region"))
    regions = table(spark, sf_dir, "region").select(F.col("r_regionkey").alias("id"), F.col("r_name").alias("name"))
    segments = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("src"), F.col("c_mktsegment").alias("dst"))
    kinds = segments.select(F.col("dst").alias("id"), F.col("dst").alias("name")).distinct()
    to_region = nations.select(F.col("id").alias("src"), F.col("region").alias("dst"))
    return nations, {"regions": (to_region, regions, "name"), "segments": (segments, kinds, "name")}


def g7_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    nations, kinds = _nation_graph(spark, sf_dir)
    found = graph.neighbours(nations, kinds)
    return found.select("id", "n_name", F.array_join("regions", ",").alias("regions"), F.array_join("segments", ",").alias("segments"))


G7 = """SELECT n_nationkey AS id, n_name, coalesce((SELECT string_agg(r_name, ',') FROM region WHERE r_regionkey = n_regionkey), '') AS regions,
  coalesce((SELECT string_agg(s, ',' ORDER BY s) FROM (SELECT DISTINCT c_nationkey, c_mktsegment AS s FROM customer) AS c WHERE c.c_nationkey = n_nationkey), '') AS segments FROM nation"""


def g8_by_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents linked to one source, newest (largest id) first."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "source", F.col("doc_id").alias("timestamp"))
    nodes = docs.select(F.col("source").alias("id"), F.col("source").alias("name")).distinct()
    edges = docs.select(F.col("id").alias("src"), F.col("source").alias("dst"))
    return graph.contexts_linked_to(docs, edges, nodes, F.col("name") == "src3").select("id", "source")


def g8_by_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contexts that name one file, found through extracted entities."""
    texts = _entity_texts(spark, sf_dir)
    entities = texts.select(F.col("id").alias("src"), F.explode(tf.code_entities(F.col("text"))).alias("e"))
    files = entities.filter("e.file_path <> ''").select("src", F.col("e.file_path").alias("dst"))
    nodes = files.select(F.col("dst").alias("id"), F.col("dst").alias("path")).distinct()
    contexts = texts.select("id", F.col("id").alias("timestamp"))
    return graph.contexts_linked_to(contexts, files, nodes, F.col("path") == "src/part_3.c").select("id")


def g8_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.session_history(_contexts(spark, sf_dir), 1).select("id", "role")


def g8_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contexts reachable backwards by FOLLOWS, with the number of steps."""
    walked = graph.chains(graph.follows(_contexts(spark, sf_dir)))
    return walked.select("start", F.col("steps").cast("int").alias("steps"), F.col("least").alias("first"))


def g8_long_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events as one session's contexts, each after the one before it by time."""
    events = table(spark, sf_dir, "events").select(F.col("event_id").alias("id"), F.col("ts").alias("timestamp"), F.lit(1).alias("session_id"))
    return graph.chains(graph.follows_by_ranges(events)).select("start", "end", "steps")


G8C = """SELECT conv_id * 1000 + turn AS start, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS INT) AS steps,
  min(conv_id * 1000 + turn) OVER (PARTITION BY conv_id) AS first FROM conversations QUALIFY steps > 0"""


G8L = """SELECT event_id AS start, first_value(event_id) OVER (ORDER BY ts, event_id) AS "end", row_number() OVER (ORDER BY ts, event_id) - 1 AS steps FROM events QUALIFY steps > 0"""


def g9_topic_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources, and one that no document has."""
    docs = table(spark, sf_dir, "documents")
    nodes = docs.select("source").distinct().unionByName(spark.sql("SELECT 'unused' AS source"))
    named = nodes.select(F.col("source").alias("id"), F.col("source").alias("name"), F.lit("d").alias("description"))
    return graph.topic_counts(named, docs.select(F.col("doc_id").alias("src"), F.col("source").alias("dst")))


def g10_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topics.topics(table(spark, sf_dir, "documents"), "doc_id", "text")


def g10k_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Phrases of all documents, by vectors fitted on them."""
    docs = table(spark, sf_dir, "documents")
    model = topics.fit_phrases(docs, "text")
    return topics.model_phrases(docs, "doc_id", "text", model).withColumn("score", F.round("score", 6))


_STOP = ", ".join(f"'{w}'" for w in topics.STOP_WORDS)
G10 = rf"""WITH w AS (SELECT doc_id, unnest(ws) AS name, unnest(range(len(ws))) AS at FROM (
  SELECT doc_id, list_filter(regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}_]+'), lambda w: regexp_matches(w, '^[a-z_]')) AS ws FROM documents) AS t),
c AS (SELECT doc_id, name, count(*) AS frequency, min(at) AS first_at FROM w WHERE length(name) >= 2 AND name NOT IN ({_STOP}) GROUP BY doc_id, name)
SELECT doc_id, name, frequency, CAST(rank AS INT) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY frequency DESC, first_at) AS rank FROM c) AS u WHERE rank <= 5""".replace(" AS at ", " AS ix ").replace("min(at)", "min(ix)")

_TEXT = """concat('See src/part_', p_size, '.c and (lib/', p_brand, '.x.py) or "a/b.yaml". def run_', p_partkey, '(x) and def run_', p_partkey,
  '(y); class Part', p_size, ': and class Part', p_size, '(Base) def Part(z)')"""


def _entity_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").selectExpr("p_partkey AS id", f"{_TEXT} AS text")


def g11_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = _entity_texts(spark, sf_dir).select("id", F.posexplode(tf.code_entities(F.col("text"))).alias("place", "e"))
    return listed.select("id", "place", "e.*")


G11 = f"""WITH t AS (SELECT p_partkey AS id, {_TEXT} AS text FROM part),
f AS (SELECT id, regexp_extract_all(text, '(?:^|[\\s''"`(])([a-zA-Z0-9_./\\\\-]+\\.(?:py|c|h|cpp|hpp|yaml|yml|json|toml|cfg|sh|md))\\b', 1) AS ps,
  regexp_extract_all(text, '\\bdef\\s+(\\w+)\\s*\\(', 1) AS fs, regexp_extract_all(text, '\\bclass\\s+(\\w+)[\\s(:]', 1) AS cs FROM t),
u AS (SELECT id, unnest(ps) AS v, 0 AS kind, unnest(range(len(ps))) AS ix FROM f UNION ALL SELECT id, unnest(fs), 1, unnest(range(len(fs))) FROM f
  UNION ALL SELECT id, unnest(cs), 2, unnest(range(len(cs))) FROM f),
d AS (SELECT id, kind, v, min(ix) AS ix FROM u GROUP BY id, kind, v)
SELECT id, CAST(row_number() OVER (PARTITION BY id ORDER BY kind, ix) - 1 AS INT) AS place, CASE kind WHEN 0 THEN v ELSE '' END AS file_path,
  CASE kind WHEN 0 THEN 'file' WHEN 1 THEN 'function' ELSE 'class' END AS entity_type,
  CASE kind WHEN 0 THEN regexp_replace(regexp_extract(v, '[^/]*$'), '\\.[^.]*$', '') ELSE v END AS name FROM d"""


def g12_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edges of the contexts that stay after all opening turns are deleted."""
    contexts = _contexts(spark, sf_dir)
    gone = contexts.filter("id % 1000 = 0").select("id")
    nodes, edges = graph.delete_nodes(contexts, graph.follows(contexts), gone)
    return edges.unionByName(nodes.select(F.col("id").alias("src"), F.lit(None).cast("long").alias("dst")))


G12 = """WITH c AS (SELECT conv_id * 1000 + turn AS id, turn, lag(conv_id * 1000 + turn) OVER (PARTITION BY conv_id ORDER BY turn) AS prev FROM conversations)
SELECT id AS src, prev AS dst FROM c WHERE prev IS NOT NULL AND id % 1000 <> 0 AND prev % 1000 <> 0 UNION ALL SELECT id, NULL FROM c WHERE id % 1000 <> 0"""


def g15_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of every table that new contexts make; each text names a file and a function."""
    made = graph.ingest(_inputs(spark, sf_dir))
    shown = {
        "contexts": ("id", "summary", "session_id", "token_count"), "sessions": ("session_id", "project"), "topics": ("id", "name"),
        "entities": ("entity", "file_path", "name", "entity_type"), "belongs_to": ("src", "dst"), "follows": ("src", "dst"),
        "contains_topic": ("src", "dst"), "references_code": ("src", "dst"),
    }
    parts = [made[name].select(F.lit(name).alias("part"), F.concat_ws("|", *columns).alias("line")) for name, columns in shown.items()]
    both = parts[0]
    for x in parts[1:]:
        both = both.unionByName(x)
    return both


def _inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contexts as they are stored: a turn, with a file by its number and a function by its role."""
    named = F.concat("full_text", F.lit(" see src/turn_"), (F.col("id") % 1000).cast("string"), F.lit(".c and def run_"), "role", F.lit("(x)"))
    return _contexts(spark, sf_dir).select(
        F.col("id").cast("string").alias("id"), F.substring("full_text", 1, 20).alias("summary"), named.alias("full_text"),
        F.col("session_id").cast("string").alias("session_id"), F.lit("p").alias("project"), "timestamp",
        F.array(F.lit(1.0)).cast("array<float>").alias("embedding"), F.array("role", F.lit("all")).alias("topics"),
    )


G15 = r"""WITH c AS (SELECT CAST(conv_id * 1000 + turn AS VARCHAR) AS id, CAST(conv_id AS VARCHAR) AS s, turn, role, text,
    CAST(lag(conv_id * 1000 + turn) OVER (PARTITION BY conv_id ORDER BY turn) AS VARCHAR) AS prev,
    'src/turn_' || (conv_id * 1000 + turn) % 1000 || '.c' AS file, 'turn_' || (conv_id * 1000 + turn) % 1000 AS stem,
    len(list_filter(regexp_split_to_array(text || ' see src/turn_1.c and def run_x(x)', '\s+'), lambda w: w <> '')) AS tokens FROM conversations)
SELECT 'contexts' AS part, concat_ws('|', id, substr(text, 1, 20), s, tokens) AS line FROM c
UNION ALL SELECT DISTINCT 'sessions', s || '|p' FROM c UNION ALL SELECT DISTINCT 'topics', role || '|' || role FROM c UNION ALL SELECT 'topics', 'all|all'
UNION ALL SELECT DISTINCT 'entities', file || chr(31) || stem || '|' || file || '|' || stem || '|file' FROM c
UNION ALL SELECT DISTINCT 'entities', chr(31) || 'run_' || role || '||run_' || role || '|function' FROM c
UNION ALL SELECT 'belongs_to', id || '|' || s FROM c UNION ALL SELECT 'follows', id || '|' || prev FROM c WHERE prev IS NOT NULL
UNION ALL SELECT 'contains_topic', id || '|' || role FROM c UNION ALL SELECT 'contains_topic', id || '|all' FROM c
UNION ALL SELECT 'references_code', id || '|' || file || chr(31) || stem FROM c UNION ALL SELECT 'references_code', id || '|' || chr(31) || 'run_' || role FROM c"""


def g13_embed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors by a stand-in for a model: the length, and how often there is an e."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    made = inference.embed(docs, lambda texts: [[float(len(t)), float(t.count("e"))] for t in texts], "text")
    return made.select("doc_id", F.col("embedding")[0].alias("n"), F.col("embedding")[1].alias("n_e"))


def _store(spark: SparkSession, sf_dir: str) -> ContextStore:
    """A store on disk with all turns, in two batches of which one is stored twice."""
    store = ContextStore(spark, scratch(spark, "store"), lambda texts: [[1.0]] * len(texts), lambda: None)
    store.init_schema()
    inputs = _inputs(spark, sf_dir)
    for part in (0, 1, 0):
        store.store_batch(inputs.filter(F.col("id") % 2 == part))
    return store


def g17_execute(spark: SparkSession, sf_dir: str) -> DataFrame:
    sql = "SELECT c.id, t.dst AS topic FROM store_contexts c JOIN store_contains_topic t ON t.src = c.id WHERE c.token_count > :n AND t.dst <> :topic"
    return _store(spark, sf_dir).execute(sql, n=20, topic="all")


def g18_file_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _store(spark, sf_dir).file_history("src/turn_2.c").select("id", "session_id")


def g18_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _store(spark, sf_dir).topics_with_counts().select("name", "context_count")


def g3_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events merged into a stored table by user and type, in three batches out of order, of which one comes twice."""
    kind = Kind(("user_id", "event_type"), "user_id long, event_type string, event_id long, value double, ts timestamp_ntz", ("ts", "event_id"), ("event_id",), ("value",))
    rows = StoredTables(spark, scratch(spark, "stored"), {"latest": kind}, 4)
    events = table(spark, sf_dir, "events")
    for part in (2, 0, 1, 0):
        rows.merge({"latest": events.filter(F.col("event_id") % 3 == part)})
    return rows.read("latest").select("user_id", "event_type", F.col("event_id").alias("id"), "value")


def g15_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sizes of a store's tables, and its edges from a context to the one before, after batches out of order."""
    made = _store(spark, sf_dir).tables()
    counts = [df.agg(F.lit(name).alias("part"), F.count(F.lit(1)).alias("n"), F.lit(None).cast("string").alias("dst")) for name, df in made.items() if name != "follows"]
    out = made["follows"].select(F.col("src").alias("part"), F.lit(1).cast("long").alias("n"), "dst")
    for x in counts:
        out = out.unionByName(x)
    return out


G15S = f"""WITH g AS ({G15}) SELECT part, count(*) AS n, CAST(NULL AS VARCHAR) AS dst FROM g WHERE part <> 'follows' GROUP BY part
UNION ALL SELECT split_part(line, '|', 1), 1, split_part(line, '|', 2) FROM g WHERE part = 'follows'"""


def _indexed(spark: SparkSession, sf_dir: str) -> str:
    path = scratch(spark, "index")
    vector_index.build_index(_embeddings(spark, sf_dir), path, "embeddings_embedding", "vec_id")
    return path


def _asking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _embeddings(spark, sf_dir).filter("vec_id % 50 = 0 or vec_id = -1")


def g6_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector whose id 50 divides asks a stored index; scores are those of the vectors."""
    found = vector_index.search_index(spark, _indexed(spark, sf_dir), _asking(spark, sf_dir), 10, "vec_id", exact=True)
    return found.select("query_id", "rank", F.round("score", 6).alias("score"))


def g6_index_recall(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the nearest lists alone give of the answers of a scan."""
    e, asked = _embeddings(spark, sf_dir), _asking(spark, sf_dir)
    found = vector_index.search_index(spark, _indexed(spark, sf_dir), asked, 10, "vec_id")
    measured = vector_index.recall(found, graph.nearest_batch(e, asked, 10, "vec_id"))
    return measured.select("n_queries", "n_exact", (F.col("recall") >= 0.9).alias("good"))


def g19_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = vector_index.list_indexes(spark, [_indexed(spark, sf_dir)])
    return listed.select("name", "property", "dimensions", "similarity", "lists", "entries", "state")


QUERIES = {f.__name__: f for f in (
    g1_unique, g3_upsert, g4_follows, g4_latest, g5_edges, g6_topk, g6_topk_batch, g6_threshold, g7_neighbours, g8_by_topic, g8_by_file,
    g3_stored, g6_index, g6_index_recall, g15_stored, g19_index, g8_history, g8_chain, g8_long_chain, g9_topic_counts, g10_topics, g10k_phrases, g11_entities, g12_delete, g13_embed, g15_ingest, g17_execute, g18_file_history, g18_topics,
)}
ORACLES = {
    "g1_unique": "SELECT md5(text) AS digest, count(*) AS n FROM documents GROUP BY md5(text) HAVING count(*) > 1",
    "g3_upsert": G3,
    "g3_stored": G3,
    "g15_stored": G15S,
    "g6_index": G6B,
    "g6_index_recall": f"""WITH k AS ({G6B}) SELECT count(DISTINCT query_id) AS n_queries, count(*) AS n_exact, true AS good FROM k""",
    "g19_index": f"""WITH {E} SELECT 'embeddings_embedding' AS name, 'embedding' AS property, 64 AS dimensions, 'cosine' AS similarity, CAST(ceil(sqrt(count(*))) AS INT) AS lists, count(*) AS entries, 'ONLINE' AS state FROM e""",
    "g4_follows": "SELECT * FROM (SELECT conv_id * 1000 + turn AS src, lag(conv_id * 1000 + turn) OVER (PARTITION BY conv_id ORDER BY turn) AS dst FROM conversations) AS t WHERE dst IS NOT NULL",
    "g4_latest": "SELECT conv_id AS session_id, max(conv_id * 1000 + turn) AS id FROM conversations GROUP BY conv_id",
    "g5_edges": G5,
    "g6_topk": f"WITH {SIMILAR} SELECT vec_id, round(score, 6) AS score FROM s ORDER BY s.score DESC, vec_id LIMIT 10",
    "g6_topk_batch": G6B,
    "g6_threshold": G6T,
    "g7_neighbours": G7,
    "g8_by_topic": "SELECT doc_id AS id, source FROM documents WHERE source = 'src3'",
    "g8_by_file": "SELECT p_partkey AS id FROM part WHERE p_size = 3",
    "g8_history": "SELECT conv_id * 1000 + turn AS id, role FROM conversations WHERE conv_id = 1",
    "g8_chain": G8C,
    "g8_long_chain": G8L,
    "g9_topic_counts": "SELECT source AS name, 'd' AS description, count(*) AS context_count FROM documents GROUP BY source UNION ALL SELECT 'unused', 'd', 0",
    "g10_topics": G10,
    "g11_entities": G11,
    "g12_delete": G12,
    "g15_ingest": G15,
    "g13_embed": "SELECT doc_id, CAST(length(text) AS FLOAT) AS n, CAST(length(text) - length(replace(text, 'e', '')) AS FLOAT) AS n_e FROM documents",
    "g17_execute": r"""SELECT CAST(conv_id * 1000 + turn AS VARCHAR) AS id, role AS topic FROM conversations
      WHERE len(list_filter(regexp_split_to_array(text || ' see src/turn_1.c and def run_x(x)', '\s+'), lambda w: w <> '')) > 20""",
    "g18_file_history": "SELECT CAST(conv_id * 1000 + turn AS VARCHAR) AS id, CAST(conv_id AS VARCHAR) AS session_id FROM conversations WHERE (conv_id * 1000 + turn) % 1000 = 2",
    "g18_topics": "SELECT role AS name, count(*) AS context_count FROM conversations GROUP BY role UNION ALL SELECT 'all', count(*) FROM conversations",
}
