"""Stored tables that are merged into by key: copy on write, one bucket at a time.

Rows live in ``buckets`` folders by a hash of their bucket columns.  A merge reads and
rewrites the buckets that its changes touch, and no other; inside a bucket files are
sorted by key, so a look-up of a key skips row groups by their least and greatest keys.
A snapshot, a small file that names the folder of every bucket of every table, makes
all tables of a merge visible at once; it is created under the next number, which fails
if another writer was faster.  Readers keep the folders that their snapshot names.

A merge keeps, for each key, the ``first`` columns of its earliest row and the ``last``
columns of its latest, whatever order the batches come in, and one row; so a batch that
is merged twice changes nothing, and reading groups nothing.
"""

from __future__ import annotations

import json
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.files import exists

BUCKETS = 16


@dataclass(frozen=True)
class Kind:
    """How a table is merged.

    ``columns``: names and types of what comes in; of these the key, ``first`` and ``last``
    are stored.  ``order``: columns that tell early rows from late ones.
    """

    key: tuple[str, ...]
    columns: str
    order: tuple[str, ...] = ()
    first: tuple[str, ...] = ()
    last: tuple[str, ...] = ()
    #: Columns whose hash names the bucket; by default the key.
    by: tuple[str, ...] = ()
    #: Columns (text) that are computed anew from a whole bucket: SQL expressions by name.
    derived: dict[str, str] = field(default_factory=dict)

    def types(self) -> dict[str, str]:
        return dict(c.split(" ", 1) for c in self.columns.split(", "))

    def stored(self) -> list[str]:
        return [c for c in self.types() if c in (*self.key, *self.first, *self.last)]


class ChangedMeanwhileError(Exception):
    """Another writer committed first; the merge can be tried again."""


class StoredTables:
    def __init__(self, spark: SparkSession, root: str, kinds: dict[str, Kind], buckets: int = BUCKETS):
        self.spark, self.root, self.kinds, self.buckets = spark, root.rstrip("/"), kinds, buckets

    # Snapshots.

    def _fs(self, path: str):  # noqa: ANN202
        jvm_path = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return jvm_path.getFileSystem(self.spark._jsc.hadoopConfiguration()), jvm_path

    def versions(self) -> list[int]:
        if not exists(self.spark, f"{self.root}/snapshots"):
            return []
        fs, path = self._fs(f"{self.root}/snapshots")
        return sorted(int(f.getPath().getName().split(".")[0]) for f in fs.listStatus(path))

    def snapshot(self, version: int | None = None) -> tuple[int, dict[str, dict[str, str]]]:
        """Number of the newest snapshot (0: none), or of ``version``, and the folder of each bucket by table."""
        known = self.versions()
        if not known:
            return 0, {name: {} for name in self.kinds}
        version = version or known[-1]
        fs, path = self._fs(f"{self.root}/snapshots/{version:09d}.json")
        stream = fs.open(path)
        text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        stream.close()
        return version, {name: {} for name in self.kinds} | json.loads(text)

    def _commit(self, version: int, folders: dict[str, dict[str, str]]) -> None:
        fs, path = self._fs(f"{self.root}/snapshots/{version:09d}.json")
        try:
            out = fs.create(path, False)
        except Exception as e:
            if fs.exists(path):
                raise ChangedMeanwhileError(f"snapshot {version} is there") from e
            raise
        out.write(bytearray(json.dumps(folders, sort_keys=True).encode()))
        out.close()

    # Reading.

    def _schema(self, name: str) -> str:
        kind = self.kinds[name]
        types = kind.types()
        at = ",".join(f"{c}:{types[c]}" for c in kind.order)
        spans = [f"__early struct<{at}>", f"__late struct<{at}>"] if kind.order else []
        return ", ".join([*(f"{c} {types[c]}" for c in kind.stored()), *spans, *(f"{c} string" for c in kind.derived)])

    def _read(self, name: str, folders: list[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], self._schema(name))
        return self.spark.read.schema(self._schema(name)).parquet(*[f"{self.root}/{f}" for f in folders])

    def read(self, name: str, version: int | None = None) -> DataFrame:
        """The table as of the newest snapshot, or of ``version``: a plain scan."""
        _, folders = self.snapshot(version)
        return self._read(name, sorted(folders[name].values())).drop("__early", "__late")

    def look_up(self, name: str, **by: object) -> DataFrame:
        """Rows whose bucket columns have these values: one bucket is read."""
        kind, (_, folders) = self.kinds[name], self.snapshot()
        columns = kind.by or kind.key
        types = kind.types()
        one = self.spark.range(1).select(*[F.lit(by[c]).cast(types[c]).alias(c) for c in columns])
        bucket = str(one.select(self._bucket(kind)).first()[0])
        rows = self._read(name, [folders[name][bucket]] if bucket in folders[name] else [])
        for c in columns:
            rows = rows.filter(F.col(c) == F.lit(by[c]))
        return rows.drop("__early", "__late")

    # Merging.

    def _bucket(self, kind: Kind) -> Column:
        return F.pmod(F.xxhash64(*(kind.by or kind.key)), F.lit(self.buckets)).cast("int")

    def _merged(self, name: str, rows: DataFrame) -> DataFrame:
        """One row for each key of ``rows`` (with __early and __late), and the derived columns."""
        kind = self.kinds[name]
        if kind.order:
            found = [F.min_by(c, "__early").alias(c) for c in kind.first] + [F.max_by(c, "__late").alias(c) for c in kind.last]
            one = rows.groupBy(*kind.key).agg(*found, F.min("__early").alias("__early"), F.max("__late").alias("__late"))
        else:
            one = rows.select(*kind.key).distinct()
        for c, made in kind.derived.items():
            one = one.withColumn(c, F.expr(made).cast("string"))
        return one.withColumn("bucket", self._bucket(kind))

    def merge(self, changes: dict[str, DataFrame]) -> int:
        """Merge rows into the tables named; the number of the new snapshot.

        Buckets that no change falls into keep their folders.
        """
        version, folders = self.snapshot()
        batch = f"{version + 1:09d}-{uuid.uuid4().hex[:8]}"
        # The tables' jobs run beside each other; none is visible before all are written.
        with ThreadPoolExecutor(max(1, len(changes))) as pool:
            made = pool.map(lambda change: self._merge_one(*change, folders[change[0]], batch), changes.items())
            folders = folders | {name: folders[name] | new for name, new in zip(changes, made, strict=True)}
        self._commit(version + 1, folders)
        return version + 1

    def _merge_one(self, name: str, given: DataFrame, held: dict[str, str], batch: str) -> dict[str, str]:
        """The new folders of the buckets of a table that ``given`` touches."""
        kind = self.kinds[name]
        rows = given.select(*[F.col(c).cast(t).alias(c) for c, t in kind.types().items()])
        at = F.struct(*kind.order) if kind.order else None
        rows = rows.select(*kind.stored(), *([at.alias("__early"), at.alias("__late")] if kind.order else []))
        # The changes are written first: what they touch and what is merged must be the same rows.
        staged = f"{self.root}/staged/{name}-{batch}"
        rows.withColumn("bucket", self._bucket(kind)).write.parquet(staged)
        change = self.spark.read.parquet(staged)
        # At most as many as there are buckets.
        touched = [str(r[0]) for r in change.select("bucket").distinct().collect()]
        if not touched:
            return {}
        both = change.drop("bucket").unionByName(self._read(name, [held[b] for b in touched if b in held]).drop(*kind.derived))
        target = f"{name}/{batch}"
        out = self._merged(name, both)
        # A bucket that is much larger than others may be split over tasks.
        out.hint("rebalance", "bucket").sortWithinPartitions("bucket", *kind.key).write.partitionBy("bucket").parquet(f"{self.root}/{target}")
        return {b: f"{target}/bucket={b}" for b in touched}

    def vacuum(self, keep: int = 1) -> list[str]:
        """Remove snapshots but the newest ``keep``, and folders that none of these names; their names."""
        known = self.versions()
        for version in known[:-keep]:
            fs, path = self._fs(f"{self.root}/snapshots/{version:09d}.json")
            fs.delete(path, False)
        live = {folder for version in known[-keep:] for held in self.snapshot(version)[1].values() for folder in held.values()}
        gone = []
        for name in [*self.kinds, "staged"]:
            if not exists(self.spark, f"{self.root}/{name}"):
                continue
            fs, path = self._fs(f"{self.root}/{name}")
            for batch in fs.listStatus(path):
                if name == "staged":
                    fs.delete(batch.getPath(), True)
                    continue
                for bucket in fs.listStatus(batch.getPath()):
                    folder = f"{name}/{batch.getPath().getName()}/{bucket.getPath().getName()}"
                    if bucket.isDirectory() and folder not in live:
                        fs.delete(bucket.getPath(), True)
                        gone.append(folder)
        return gone
