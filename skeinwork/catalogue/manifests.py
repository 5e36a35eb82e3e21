"""Queries of listings and manifests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as tf
from ..operators import manifest, monitor
from .tables import table

PREFIXES = [("http://m.", "mobile"), ("http://", "plain"), ("https://www.", "www"), ("https://m.", "mobile")]


def x1_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every fifth key stands for a folder, every tenth is an empty one."""
    path = "concat('k', doc_id, CASE WHEN doc_id % 5 = 0 THEN '/' ELSE '.c' END) AS path"
    size = "CASE WHEN doc_id % 10 = 0 THEN 0 ELSE n_chars END AS length"
    return manifest.listing(table(spark, sf_dir, "documents").selectExpr(path, size))


def x2_prefix_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", manifest.classify_prefix(F.col("url"), PREFIXES).alias("domain"))


X2 = """SELECT page_id, CASE WHEN starts_with(url, 'http://m.') THEN 'mobile' WHEN starts_with(url, 'http://') THEN 'plain'
  WHEN starts_with(url, 'https://www.') THEN 'www' WHEN starts_with(url, 'https://m.') THEN 'mobile' ELSE 'other' END AS domain FROM pages"""


def _files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(F.col("source").alias("domain"), F.col("n_chars").alias("length"))


def x3_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    domains = spark.sql("SELECT concat('src', id) AS domain FROM range(25)")
    return manifest.per_domain(_files(spark, sf_dir), domains)


X3 = """SELECT d.domain, count(s.doc_id) AS file_count, CAST(coalesce(sum(s.n_chars), 0) AS BIGINT) AS total_size
FROM (SELECT 'src' || i AS domain FROM range(25) AS t(i)) AS d LEFT JOIN documents s ON s.source = d.domain GROUP BY d.domain"""


def x3_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.with_totals(_files(spark, sf_dir))


def x6_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.with_totals(_files(spark, sf_dir)).filter("domain is null").select("total_size")


def x7_format_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("size", F.col("n_chars") * F.pow(F.lit(37), F.col("doc_id") % 9))
    return docs.select("doc_id", tf.human_size(F.col("size")).alias("s")).select("doc_id", "s.number", "s.unit")


_STEPS = [("B", 0), ("KB", 1), ("MB", 2), ("GB", 3), ("TB", 4)]
X7 = (
    "WITH t AS (SELECT doc_id, n_chars * pow(37, doc_id % 9) AS s FROM documents) SELECT doc_id, round(CASE "
    + " ".join(f"WHEN s / pow(1024, {i}) < 1024 THEN s / pow(1024, {i})" for _, i in _STEPS)
    + " ELSE s / pow(1024, 5) END, 1) AS number, CASE "
    + " ".join(f"WHEN s / pow(1024, {i}) < 1024 THEN '{u}'" for u, i in _STEPS)
    + " ELSE 'PB' END AS unit FROM t"
)


def x8_manifest_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.manifest_json(manifest.with_totals(_files(spark, sf_dir)))


X8 = """WITH d AS (SELECT source, count(*) AS c, sum(n_chars) AS s FROM documents GROUP BY source)
SELECT '{"domains":[' || string_agg('{"domain":"' || source || '","file_count":' || c || ',"total_size":' || s || '}', ',' ORDER BY source)
  || '],"total_files":' || CAST(sum(c) AS BIGINT) || ',"total_size":' || CAST(sum(s) AS BIGINT) || '}' AS manifest FROM d"""


def x10_first_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    results = table(spark, sf_dir, "events").select("event_id", "event_type", (F.col("value") <= 100).alias("passed"))
    return monitor.first_failures(results, "event_id").select("event_id", "event_type")


QUERIES = {f.__name__: f for f in (
    x1_listing, x2_prefix_class, x3_manifest, x3_rollup, x6_total, x7_format_size, x8_manifest_json, x10_first_failures,
)}
ORACLES = {
    "x1_listing": """SELECT * FROM (SELECT concat('k', doc_id, CASE WHEN doc_id % 5 = 0 THEN '/' ELSE '.c' END) AS path,
      CASE WHEN doc_id % 10 = 0 THEN 0 ELSE n_chars END AS length FROM documents) AS t WHERE NOT (ends_with(path, '/') AND length = 0)""",
    "x2_prefix_class": X2,
    "x3_manifest": X3,
    "x3_rollup": "SELECT source AS domain, count(*) AS file_count, CAST(sum(n_chars) AS BIGINT) AS total_size FROM documents GROUP BY ROLLUP (source)",
    "x6_total": "SELECT CAST(sum(n_chars) AS BIGINT) AS total_size FROM documents",
    "x7_format_size": X7,
    "x8_manifest_json": X8,
    "x10_first_failures": "SELECT event_id, event_type FROM events WHERE value > 100 ORDER BY event_id LIMIT 10",
}
