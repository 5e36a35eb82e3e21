"""A session with the settings that the operators assume."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def session(app: str = "skeinwork", **conf: str) -> SparkSession:
    """UTC, adaptive execution with skew splitting; other settings by keyword.

    Keywords use underscores for dots, as in ``spark_sql_shuffle_partitions="400"``.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("_", "."), value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Where it is unset, a temporary one; on a cluster it must be set.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return tempfile.mkdtemp(prefix="skeinwork-")


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder's path below the shared one."""
    return f"{shared_folder(spark)}/skeinwork-tables/{name}-{uuid.uuid4().hex}"


def written(rows: DataFrame, name: str) -> DataFrame:
    """``rows`` as a table in the shared folder, read again: its lineage ends, and it never changes."""
    path = scratch(rows.sparkSession, name)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)
