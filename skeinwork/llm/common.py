"""Helpers shared by the operators of this subpackage.

Texts cross into Python as UTF-8 bytes (``binary`` columns through
``mapInArrow``): byte strings lower-case and split ASCII at C speed and need no
decoding.  Intermediate tables are written to the folder that the cluster names
in ``spark.checkpoint.dir``, so a lost executor never loses a table.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextvars import ContextVar
from typing import Any

import pyarrow as pa
from pyspark.serializers import CPickleSerializer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII upper case, for translate(): the contracts lower-case A-Z only.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Maps every byte of a text for the alphanumeric word rule: A-Z to a-z, digits,
#: a-z and all bytes of non-ASCII code points to themselves, the rest to a blank.
WORD_TABLE = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
    for b in range(256)
)

#: Records and bytes of text that one Arrow batch may hold.
BATCH_ROWS = 1000
BATCH_BYTES = 16 << 20


class Tables:
    """The tables that ``cut`` writes inside a ``with`` block, in this thread.

    Only their owner removes them, so operators that run beside each other in one
    session never take each other's.  What is left at the end of a block goes to the
    block around it.
    """

    def __init__(self):
        self.paths: list[str] = []

    def __enter__(self) -> Tables:
        self._token = _OWNER.set(self)
        return self

    def __exit__(self, *_: object) -> None:
        _OWNER.reset(self._token)
        if outer := _OWNER.get():
            outer.paths += self.paths

    def drop(self, spark: SparkSession, keep: str = "") -> None:
        """Remove the tables, but for those named ``keep``, once all that reads them is stored."""
        for path in self.paths:
            if not keep or not path.rsplit("/", 1)[1].startswith(keep + "-"):
                jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
                jvm_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(jvm_path, True)
        self.paths = [x for x in self.paths if keep and x.rsplit("/", 1)[1].startswith(keep + "-")]


_OWNER: ContextVar[Tables | None] = ContextVar("owner", default=None)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def alnum_words(text: bytes) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z."""
    return text.translate(WORD_TABLE).split()


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share; a temporary one where none is set."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        jvm_dir = spark.sparkContext._jsc.sc().getCheckpointDir()
        base = jvm_dir.get() if jvm_dir.isDefined() else None
    if not base:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="skeinwork-")
        spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")


def cut(df: DataFrame, name: str, *sort: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it again, which ends its lineage."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/skeinwork/{name}-{uuid.uuid4().hex}"
    if owner := _OWNER.get():
        owner.paths.append(path)
    writer = df.sortWithinPartitions(*sort) if sort else df
    writer.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches by rows and bytes, whatever the length of the texts.

    The settings stay: plans are made when a result is used, after the operator has returned.
    """
    for key, value in (
        ("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS),
        ("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES),
    ):
        spark.conf.set(key, str(value))


def in_task(spark: SparkSession, make: Callable[..., Any], *args: Any) -> Any:
    """``make(*args)`` as a task of its own: it runs again if its executor is lost."""
    sent = spark.sparkContext.broadcast(args)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _ in batches:
            made = CPickleSerializer().dumps(make(*sent.value))
            yield pa.RecordBatch.from_arrays([pa.array([made], type=pa.binary())], names=["made"])

    row = spark.range(0, 1, 1, 1).mapInArrow(run, "made binary").first()
    return CPickleSerializer().loads(bytes(row["made"]))


def utf8(column: str | Column) -> Column:
    """The UTF-8 bytes of a text; null counts as empty."""
    column = F.col(column) if isinstance(column, str) else column
    return F.coalesce(column.cast("string"), F.lit("")).cast("binary")


def record_batch(columns: dict[str, list], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[f.name], type=f.type) for f in schema], schema=schema
    )
