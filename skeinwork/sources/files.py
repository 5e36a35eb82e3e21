"""Code files and JSON lines as tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import decode_code
from ..operators.manifest import listing
from ..schemas import CORRECTION, PROMPT, SPLIT_LINE
from ..session import written
from .fixed import EVAL_PROMPTS

#: Suffixes of code files, in the order in which they are listed.
EXTENSIONS = [".c", ".h", ".cpp", ".cc", ".cxx", ".txt"]


def read_code_files(spark: SparkSession, root: str) -> DataFrame:
    """path, length, code of all files below ``root`` with one of the suffixes (case matters)."""
    suffixes = ",".join(e[1:] for e in EXTENSIONS)
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", f"*.{{{suffixes}}}")
        .load(root)
    )
    return files.select("path", "length", decode_code(F.col("content")).alias("code"))


def with_source(files: DataFrame, root: str, sources: list[tuple[str, str, list[str]]]) -> DataFrame:
    """``files`` below a source's prefix, with its domain and contexts; the first source that fits."""
    key = F.substring_index(F.col("path"), root.rstrip("/") + "/", -1)
    domain, contexts = F.lit(None).cast("string"), F.lit(None).cast("array<string>")
    for prefix, name, listed in reversed(sources):
        here = key.startswith(prefix)
        domain = F.when(here, F.lit(name)).otherwise(domain)
        contexts = F.when(here, F.array(*[F.lit(c) for c in listed])).otherwise(contexts)
    return files.withColumn("domain", domain).withColumn("contexts", contexts).filter("domain is not null")


def cap_per_domain(files: DataFrame, n: int) -> DataFrame:
    """The first ``n`` files of each domain by suffix, then path; 0 keeps all."""
    if not n:
        return files
    rank = F.lit(len(EXTENSIONS))
    for i, e in reversed(list(enumerate(EXTENSIONS))):
        rank = F.when(F.col("path").endswith(e), i).otherwise(rank)
    # Only paths are ranked, and met by their rows; a rank of a domain's start is cut off early.
    order = Window.partitionBy("domain").orderBy("__ext", "path")
    ranked = files.select("domain", "path").distinct().withColumn("__ext", rank).withColumn("__r", F.row_number().over(order))
    return files.join(ranked.filter(F.col("__r") <= n).select("domain", "path"), ["domain", "path"], "left_semi")


def read_prompts(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PROMPT).json(path)


def read_split(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SPLIT_LINE).json(path)


def write_split(examples: DataFrame, path: str, single_file: bool = False) -> None:
    """JSON lines of messages only."""
    out = examples.select("messages")
    (out.coalesce(1) if single_file else out).write.mode("overwrite").json(path)


def lines_in_order(spark: SparkSession, path: str) -> DataFrame:
    """value, place of the lines below ``path``: files by name, lines as they stand, from 0."""
    mark = F.monotonically_increasing_id().alias("mark")
    lines = written(spark.read.text(path).select("value", "_metadata.file_path", "_metadata.file_block_start", mark), "lines")
    parts = lines.groupBy("file_path", "file_block_start").agg(F.min("mark").alias("first"), F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("file_path", "file_block_start").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select("file_path", "file_block_start", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    return lines.join(starts, ["file_path", "file_block_start"]).select("value", (F.col("start") + F.col("mark") - F.col("first")).alias("place"))


def exists(spark: SparkSession, path: str) -> bool:
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jvm_path)


def first_existing(spark: SparkSession, paths: list[str]) -> DataFrame:
    """The split at the first of ``paths`` that is there."""
    for path in paths:
        if exists(spark, path):
            return read_split(spark, path)
    raise FileNotFoundError(f"none of {paths}")


def cached_splits(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame] | None:
    """Train and val splits, if both are there."""
    paths = [f"{folder}/train.jsonl", f"{folder}/val.jsonl"]
    if all(exists(spark, p) for p in paths):
        return read_split(spark, paths[0]), read_split(spark, paths[1])
    return None


def append_metrics(metrics: DataFrame, path: str, batch: str | None = None) -> None:
    """Append JSON lines; a named batch that is appended again replaces its own lines."""
    if batch is None:
        metrics.write.mode("append").json(path)
    else:
        metrics.write.mode("overwrite").json(f"{path}/batch={batch}")


def write_corrections(corrections: DataFrame, folder: str, epoch: int) -> DataFrame:
    """JSON lines of an epoch's corrections, also appended to those of all epochs; read back.

    A repeated epoch replaces its own lines, and is appended once more.
    """
    spark, own = corrections.sparkSession, f"{folder}/epoch_{epoch}_corrections.jsonl"
    corrections.write.mode("overwrite").json(own)
    written = spark.read.schema(CORRECTION).json(own)
    written.write.mode("append").json(accumulated_corrections(folder))
    return written


def accumulated_corrections(folder: str) -> str:
    return f"{folder}/accumulated_corrections.jsonl"


def load_datasets(spark: SparkSession, train_dir: str, output_dir: str, eval_dir: str) -> tuple[DataFrame, DataFrame]:
    """The training split, or else the accumulated corrections; evaluation prompts, or else the built-in ones."""
    train = first_existing(spark, [f"{train_dir}/train.jsonl", accumulated_corrections(f"{output_dir}/corrections")])
    prompts = f"{eval_dir}/eval_prompts.jsonl"
    if exists(spark, prompts):
        return train, read_prompts(spark, prompts)
    return train, spark.createDataFrame(EVAL_PROMPTS, PROMPT)


def list_files(spark: SparkSession, prefix: str) -> DataFrame:
    """path, length of every file below a prefix, folders' empty keys left out."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(prefix)
    return listing(files.select("path", "length"))


def write_single_json(row: DataFrame, path: str) -> None:
    row.coalesce(1).write.mode("overwrite").json(path)
