"""Code files to deduplicated, split training examples in one plan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.examples import training_examples
from ..operators.splits import deduplicate, digest, exact_split, shuffled
from ..sources.files import cap_per_domain, read_code_files, with_source, write_split
from ..sources.fixed import SOURCES


def prepare(
    spark: SparkSession, root: str, max_files: int = 0, ratio: float = 0.9, seed: int = 42, sources: list = SOURCES
) -> DataFrame:
    """messages, metadata, split of all files below ``root``."""
    files = cap_per_domain(with_source(read_code_files(spark, root), root, sources), max_files)
    examples = training_examples(files, seed).withColumn("key", digest(F.col("messages")))
    first = deduplicate(examples, ["key"], ["metadata"])
    return exact_split(first, "key", ratio, seed).drop("key")


def write(prepared: DataFrame, folder: str, seed: int = 42, key: Column | None = None) -> None:
    """Both splits as JSON lines, shuffled by the seeded hash of ``key`` (default: the messages' digest)."""
    key = digest(F.col("messages")) if key is None else key
    for split in ("train", "val"):
        write_split(shuffled(prepared.filter(F.col("split") == split), key, seed), f"{folder}/{split}.jsonl")


def domain_counts(examples: DataFrame) -> DataFrame:
    return examples.groupBy("metadata.domain").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "domain")
