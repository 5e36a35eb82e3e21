"""The incremental forms: dedup with state, log metrics, appended metrics, run monitors."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from ..functions.text import log_metrics
from ..sources.files import exists


def dedup_lines(lines: DataFrame, delay: str | None = None, at: str = "ts") -> DataFrame:
    """First rows by the digest of the line ``value``.

    With ``delay``, state older than the watermark is dropped; without, it grows with
    the number of distinct lines.
    """
    keyed = lines.withColumn("digest", F.md5("value"))
    if delay:
        return keyed.withWatermark(at, delay).dropDuplicatesWithinWatermark(["digest"])
    return keyed.dropDuplicates(["digest"])


def store_once(lines: DataFrame, path: str, checkpoint: str, hours: float | None = None) -> StreamingQuery:
    """Write the first row of each line ``value`` below ``path``, with its digest and time; exact over restarts.

    A micro-batch meets the digests of those before it, which are what was written: no
    state is kept in memory, and one that is run again replaces its own rows.  With
    ``hours``, only rows of that time are met (files of older ones are skipped by their
    times), and a line that comes again later is written again.
    """

    def store(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        known = spark.read.schema("digest string, at timestamp, batch long").parquet(path) if exists(spark, path) else spark.createDataFrame([], "digest string, at timestamp, batch long")
        seen = known.filter(F.col("batch") < number)
        if hours is not None:
            seen = seen.filter(F.col("at") >= F.current_timestamp() - F.make_dt_interval(secs=F.lit(hours * 3600)))
        first = batch.withColumn("digest", F.md5("value")).dropDuplicates(["digest"]).withColumn("at", F.current_timestamp())
        first.join(seen.select("digest"), "digest", "left_anti").write.mode("overwrite").parquet(f"{path}/batch={number}")

    return lines.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def metrics_of_log(lines: DataFrame) -> DataFrame:
    """The metrics of log lines ``value`` that hold at least one."""
    found = lines.select(log_metrics(F.col("value")).alias("m")).select("m.*")
    return found.dropna(how="all")


def append_to(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append to JSON files; each batch is written once."""
    return stream.writeStream.format("json").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()


STOP_SCHEMA = "run string, step long, reason string"
STATE_SCHEMA = "best double, wait int, stopped boolean"


def watch_runs(log: DataFrame, patience: int = 3, threshold: float = 0.0) -> DataFrame:
    """run, step, reason: the step at which each run should stop (bad loss or no progress).

    ``log``: run, step, loss.  State for each run: best loss, evaluations since, whether
    it was stopped.
    """

    def step(key: tuple, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:  # noqa: ANN001
        best, wait, stopped = state.get if state.exists else (None, 0, False)
        found = []
        rows = pd.concat(list(batches)).sort_values("step")
        for at, loss in zip(rows["step"], rows["loss"], strict=True):
            if stopped or loss is None:
                continue
            if pd.isna(loss) or abs(loss) == float("inf"):
                stopped = True
                found.append((key[0], at, "bad loss"))
                continue
            if best is None or loss < best - threshold:
                best, wait = loss, 0
            else:
                wait += 1
            if wait >= patience:
                stopped = True
                found.append((key[0], at, "no progress"))
        state.update((best, wait, stopped))
        yield pd.DataFrame(found, columns=["run", "step", "reason"])

    return log.filter("loss is not null").groupBy("run").applyInPandasWithState(step, STOP_SCHEMA, STATE_SCHEMA, "append", "NoTimeout")
