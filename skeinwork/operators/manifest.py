"""Listings, classification by prefix and roll-ups of stored files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def listing(files: DataFrame) -> DataFrame:
    """Without the zero-byte keys that stand for folders."""
    return files.filter(~(F.col("path").endswith("/") & (F.col("length") == 0)))


def classify_prefix(key: Column, sources: list[tuple[str, str]], default: str = "other") -> Column:
    """The domain of the first source whose prefix the key has."""
    out = F.lit(default)
    for prefix, domain in reversed(sources):
        out = F.when(key.startswith(prefix), F.lit(domain)).otherwise(out)
    return out


def per_domain(files: DataFrame, domains: DataFrame, size: str = "length") -> DataFrame:
    """Every domain with file_count and total_size, zeros where it has no file."""
    stats = files.groupBy("domain").agg(F.count(F.lit(1)).alias("file_count"), F.sum(size).alias("total_size"))
    return domains.join(stats, "domain", "left").select(
        "domain", F.coalesce("file_count", F.lit(0)).alias("file_count"), F.coalesce("total_size", F.lit(0)).alias("total_size")
    )


def with_totals(files: DataFrame, size: str = "length") -> DataFrame:
    """Counts and sizes by domain, and the grand total under a null domain."""
    return files.rollup("domain").agg(F.count(F.lit(1)).alias("file_count"), F.sum(size).alias("total_size"))


def line_counts(texts: DataFrame, splits: DataFrame, by: str = "split", text: str = "text") -> DataFrame:
    """Lines by split; a split without a file has 0."""
    lines = F.length(text) - F.length(F.replace(F.col(text), F.lit("\n"))) + 1
    counted = texts.groupBy(by).agg(F.sum(F.when(F.length(text) > 0, lines).otherwise(0)).alias("n_lines"))
    return splits.join(counted, by, "left").select(by, F.coalesce("n_lines", F.lit(0)).alias("n_lines"))


def manifest_json(rolled: DataFrame) -> DataFrame:
    """One row: the roll-up as a JSON text, domains in order, with totals."""
    entry = F.struct("domain", "file_count", "total_size")
    return rolled.agg(
        F.sort_array(F.collect_list(F.when(F.col("domain").isNotNull(), entry))).alias("domains"),
        F.max(F.when(F.col("domain").isNull(), F.col("file_count"))).alias("total_files"),
        F.max(F.when(F.col("domain").isNull(), F.col("total_size"))).alias("total_size"),
    ).select(F.to_json(F.struct("domains", "total_files", "total_size")).alias("manifest"))
