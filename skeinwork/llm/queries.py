"""Queries over the driver's tables, one for each operator, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, centroids, classifier, decontam, embedding_dedup, license_scan, lm, merkle, quality_rules, sharding, simhash, substring_dedup, url_filter
from .common import table
from .oracles import ORACLES as _SQL

Query = Callable[[SparkSession, str], DataFrame]


def tokenizer_file() -> tuple[str, str]:
    """Path of the rank file, and the pattern that goes with it."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("runs")


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, pattern = tokenizer_file()
    return bpe.bpe_encode(table(spark, sf_dir, "documents"), path, pattern)


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.quality_rules(table(spark, sf_dir, "documents"))
    return judged.drop("char_distance", "word_distance")


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicate_groups(table(spark, sf_dir, "documents"))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.substring_dedup(table(spark, sf_dir, "documents"))


URL_RULES = [
    ("block", "com", "/en/"),
    ("allow", "example.com", "/en/7"),
    ("block", "net", "/de/"),
    ("block", "example.net", "/de/8"),
    ("block", "org", "/es/"),
]


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The list: urls of the pages whose id is divisible by 50, as if these had been reported."""
    pages = table(spark, sf_dir, "pages")
    return url_filter.url_filter(pages, URL_RULES, pages.filter("page_id % 50 = 0").select("url"))


def op7_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"))


def op8_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classifier.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    templates = spark.sql(
        "SELECT * FROM VALUES "
        + ", ".join(f"('{label}', '{body}')" for label, body in license_scan.TEMPLATES)
        + " AS t(label, body)"
    )
    return license_scan.license_scan(table(spark, sf_dir, "documents"), templates)


def op10_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.lm_scores(table(spark, sf_dir, "documents"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return merkle.verified_manifest(docs, merkle.tampered_text(docs))


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    assigned, final = centroids.clustering(table(spark, sf_dir, "embeddings"))
    named = final.select("cluster", "cluster_inertia", "inertia", F.sha2(F.array_join("centroid", ","), 256).alias("centroid_sha256"))
    return assigned.join(F.broadcast(named), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def op13_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicate_vectors(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Query] = {
    "op1_decontaminate": op1_decontaminate,
    "op2_byte_bpe": op2_byte_bpe,
    "op3_quality_rules": op3_quality_rules,
    "op4_substring_dedup": op4_substring_dedup,
    "op5_simhash": op5_simhash,
    "op6_url_filter": op6_url_filter,
    "op7_shards": op7_shards,
    "op8_classifier": op8_classifier,
    "op9_license_scan": op9_license_scan,
    "op10_lm_scores": op10_lm_scores,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_centroids": op12_centroids,
    "op13_embedding_dedup": op13_embedding_dedup,
}
ORACLES: dict[str, str] = dict(_SQL)
