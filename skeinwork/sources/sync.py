"""Incremental copies of a folder tree: what is new or changed, and nothing else.

``Listing`` is a Python data source: a read of ``files`` lists the folders below a root,
a partition for each folder, and only those that a prefix allows.  Two listings meet in
an anti join by path, size and time, and the files that are left are copied by the
tasks that hold their rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

LISTED = "path string, length long, modified timestamp"
#: Rows of an Arrow batch of a listing.
PAGE = 10_000


class Prefix(InputPartition):
    def __init__(self, value: str, deep: bool):
        super().__init__(value)
        self.deep = deep


class ListingReader(DataSourceReader):
    """Lists ``root``; files whose path does not begin with ``prefix``, and their folders, are left out.

    The prefix is an option, not a pushed filter: Spark keeps what it once pushed into a
    Python source for later queries of the same table.
    """

    def __init__(self, root: str, prefix: str):
        self.root, self.prefix = root, prefix

    def partitions(self) -> list[Prefix]:
        """The files of the root itself, and each folder in it whose files may be asked for."""
        store, base = fs.FileSystem.from_uri(self.root)
        found = store.get_file_info(fs.FileSelector(base, allow_not_found=True))
        below = sorted(f"{i.base_name}/" for i in found if i.type == fs.FileType.Directory)
        return [Prefix("", False), *[Prefix(f, True) for f in below if f.startswith(self.prefix) or self.prefix.startswith(f)]]

    def read(self, partition: Prefix) -> Iterator[pa.RecordBatch]:
        store, base = fs.FileSystem.from_uri(self.root)
        start = f"{base}/{partition.value}".rstrip("/")
        found = store.get_file_info(fs.FileSelector(start, recursive=partition.deep, allow_not_found=True))
        rows = [(i.path[len(base) :].lstrip("/"), i.size, i.mtime) for i in found if i.type == fs.FileType.File]
        rows = [r for r in rows if r[0].startswith(self.prefix)]
        schema = pa.schema([("path", pa.string()), ("length", pa.int64()), ("modified", pa.timestamp("us", "UTC"))])
        for i in range(0, len(rows), PAGE):
            columns = zip(*rows[i : i + PAGE], strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


class Listing(DataSource):
    """``spark.read.format("files").load(uri)``: path below the root, length, modified; a row per file."""

    @classmethod
    def name(cls) -> str:
        return "files"

    def schema(self) -> str:
        return LISTED

    def reader(self, schema: object) -> ListingReader:
        return ListingReader(self.options["path"], self.options.get("prefix", ""))


def listing(spark: SparkSession, root: str, prefix: str = "") -> DataFrame:
    """path (below ``root``), length, modified of every file whose path begins with ``prefix``.

    ``root`` is a URI, such as ``file:///data``.
    """
    spark.dataSource.register(Listing)
    return spark.read.format("files").option("prefix", prefix).load(root.rstrip("/"))


def outdated(source: DataFrame, target: DataFrame) -> DataFrame:
    """Files of ``source`` that ``target`` lacks, has in another size, or has from an earlier time."""
    held = target.select(F.col("path").alias("held"), F.col("length").alias("held_length"), F.col("modified").alias("held_modified"))
    same = (F.col("path") == F.col("held")) & (F.col("length") == F.col("held_length")) & (F.col("modified") <= F.col("held_modified"))
    return source.join(held, same, "left_anti")


def removed(source: DataFrame, target: DataFrame) -> DataFrame:
    """Files of ``target`` that ``source`` does not have."""
    return target.join(source.select("path"), "path", "left_anti")


def copy_files(files: DataFrame, source: str, target: str, tasks: int = 32) -> DataFrame:
    """path, length, error of each file after it was copied from ``source`` to ``target``.

    A file is written under another name and then moved, so no reader meets half of it
    and a task that is run again does no harm.  Every action copies: store the result.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        (store, base), (out, place) = fs.FileSystem.from_uri(source), fs.FileSystem.from_uri(target)
        for batch in batches:
            done = []
            for path, length in zip(batch["path"], batch["length"], strict=True):
                error, parent = None, f"{place}/{path}".rsplit("/", 1)[0]
                try:
                    out.create_dir(parent, recursive=True)
                    partial = f"{parent}/.{path.rsplit('/', 1)[-1]}.partial"
                    fs.copy_files(f"{base}/{path}", partial, source_filesystem=store, destination_filesystem=out)
                    out.move(partial, f"{place}/{path}")
                except OSError as e:  # one file must not end the copy
                    error = str(e)
                done.append((path, length, error))
            yield pd.DataFrame(done, columns=["path", "length", "error"])

    return files.select("path", "length").repartition(tasks).mapInPandas(run, "path string, length long, error string")


def sync(spark: SparkSession, source: str, target: str, report: str, tasks: int = 32) -> DataFrame:
    """Copy what ``target`` lacks or has outdated; what was copied is stored below ``report`` and read from there.

    Nothing is removed from ``target``.
    """
    todo = outdated(listing(spark, source), listing(spark, target))
    copy_files(todo, source, target, tasks).write.mode("overwrite").parquet(report)
    return spark.read.schema("path string, length long, error string").parquet(report)
