"""Monitors over training logs: tables of (run, step, value)."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def early_stopping(log: DataFrame, run: str = "run", patience: int = 3, threshold: float = 0.0) -> DataFrame:
    """run, stop_step (null if it never stops), best: a fold over each run's eval losses.

    An evaluation improves if it is below the best by more than ``threshold``, and only
    then moves the best.  Null losses are skipped; NaN never improves.  Runs stream past
    in order of step, with three numbers of state, however long they are.
    """

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, best, wait, stop = None, None, 0, None
        started = False
        for batch in batches:
            runs, steps, losses = (batch.column(i) for i in range(3))
            out: list[tuple] = []
            for name, step, loss in zip(runs.to_pylist(), steps.to_pylist(), losses.to_pylist(), strict=True):
                if not started or name != key:
                    if started:
                        out.append((key, stop, best))
                    key, best, wait, stop, started = name, None, 0, None, True
                if stop is not None:
                    continue
                if loss == loss and (best is None or loss < best - threshold):
                    best, wait = loss, 0
                else:
                    wait += 1
                if wait >= patience:
                    stop = step
            yield _rows(out, batch.schema.field(0).type)
        if started:
            yield _rows([(key, stop, best)], runs.type)

    def _rows(out: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
        columns = list(zip(*out, strict=True)) or [(), (), ()]
        kinds = (kind, pa.int64(), pa.float64())
        return pa.RecordBatch.from_arrays([pa.array(c, type=k) for c, k in zip(columns, kinds, strict=True)], names=["run", "stop_step", "best"])

    points = log.select(F.col(run).alias("run"), F.col("step").cast("long").alias("step"), F.col("loss").cast("double").alias("loss")).filter("loss is not null")
    ordered = points.repartition("run").sortWithinPartitions("run", "step", "loss")
    kind = points.schema["run"].dataType.simpleString()
    return ordered.mapInArrow(fold, f"run {kind}, stop_step long, best double").withColumnRenamed("run", run)


def first_bad_loss(log: DataFrame, run: str = "run") -> DataFrame:
    """run, step: the first step whose loss is NaN or infinite; null for runs without."""
    bad = F.isnan("loss") | (F.abs("loss") == F.lit(float("inf")))
    return log.groupBy(run).agg(F.min(F.when(bad, F.col("step"))).alias("bad_step"))


def _latest(log: DataFrame, run: str, n: int, value: str = "loss") -> DataFrame:
    """The last ``n`` rows of each run, numbered from 1 at the end."""
    back = F.row_number().over(Window.partitionBy(run).orderBy(F.desc("step")))
    return log.withColumn("__back", back).filter(F.col("__back") <= n)


def loss_spikes(log: DataFrame, run: str = "run", factor: float = 2.0) -> DataFrame:
    """run, spike_step: the first step whose loss is over ``factor`` times the one before."""
    before = F.lag("loss").over(Window.partitionBy(run).orderBy("step"))
    marked = log.withColumn("__spike", F.col("loss") > before * factor)
    return marked.groupBy(run).agg(F.min(F.when(F.col("__spike"), F.col("step"))).alias("spike_step"))


def divergence(log: DataFrame, run: str = "run", limit: float = 1e10) -> DataFrame:
    return log.groupBy(run).agg(F.bool_or(F.col("loss") > limit).alias("diverged"))


def converging(log: DataFrame, run: str = "run", n: int = 3) -> DataFrame:
    """Whether the mean of the last ``n`` losses is below that of the first ``n``."""
    by = Window.partitionBy(run)
    ranked = log.withColumn("__a", F.row_number().over(by.orderBy("step"))).withColumn(
        "__z", F.row_number().over(by.orderBy(F.desc("step")))
    )
    first, last = F.avg(F.when(F.col("__a") <= n, F.col("loss"))), F.avg(F.when(F.col("__z") <= n, F.col("loss")))
    return ranked.groupBy(run).agg(first.alias("first_mean"), last.alias("last_mean"), (last < first).alias("converging"))


def plateau(log: DataFrame, run: str = "run", patience: int = 3, variance: float = 0.01) -> DataFrame:
    """Whether the last ``patience`` losses vary by less; needs one more point than that."""
    n = log.groupBy(run).agg(F.count(F.lit(1)).alias("__n"))
    last = _latest(log, run, patience).groupBy(run).agg(F.var_pop("loss").alias("__v"))
    return n.join(last, run).select(run, ((F.col("__n") > patience) & (F.col("__v") < variance)).alias("plateau"))


def fit_trend(log: DataFrame, run: str = "run", n: int = 3, high: float = 2.5) -> DataFrame:
    """overfit: train falls and val rises over the last ``n`` steps; underfit: both means are high."""
    last = _latest(log, run, n)
    train, val = F.regr_slope("train_loss", -F.col("__back")), F.regr_slope("val_loss", -F.col("__back"))
    return last.groupBy(run).agg(
        ((train < 0) & (val > 0)).alias("overfit"),
        ((F.avg("train_loss") > high) & (F.avg("val_loss") > high)).alias("underfit"),
    )


def gradient_health(log: DataFrame, run: str = "run", tiny: float = 1e-7, huge: float = 1e3, n: int = 3) -> DataFrame:
    """vanishing: the last ``n`` norms are tiny; exploding: any is huge."""
    last = _latest(log, run, n).groupBy(run).agg(F.bool_and(F.abs("loss") < tiny).alias("vanishing"))
    return last.join(log.groupBy(run).agg(F.bool_or(F.abs("loss") > huge).alias("exploding")), run)


def best_checkpoint(log: DataFrame, run: str = "run") -> DataFrame:
    """run, step, loss with the least loss; the earliest on ties."""
    least = F.min(F.struct("loss", "step"))
    return log.filter("loss is not null").groupBy(run).agg(least.alias("x")).select(
        run, F.col("x.step").alias("step"), F.col("x.loss").alias("loss")
    )


def warmup_cosine(step: Column, warmup: int, total: int, peak: float) -> Column:
    """Linear warm-up to ``peak``, then half a cosine down to zero."""
    progress = (step - warmup) / F.lit(float(max(1, total - warmup)))
    down = F.lit(0.5 * peak) * (F.lit(1.0) + F.cos(progress * F.pi()))
    return F.when(step < warmup, F.lit(peak) * step / F.lit(float(max(1, warmup)))).otherwise(down)


def validate_messages(rows: DataFrame, messages: str = "messages") -> DataFrame:
    """One row of counts: rows, no_messages, no_role, no_content."""
    m = F.col(messages)
    first = F.get(m, 0)
    empty = m.isNull() | (F.size(m) == 0)
    return rows.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(empty).alias("no_messages"),
        F.count_if(~empty & first["role"].isNull()).alias("no_role"),
        F.count_if(~empty & first["content"].isNull()).alias("no_content"),
    )


def validate_datasets(train: DataFrame, val: DataFrame, least_val: int = 3) -> list[str]:
    """Errors and warnings as texts; an empty list if all is well.  Every row is checked."""
    found = []
    counts = validate_messages(train).first()
    n_val = val.count()
    if not counts["n_rows"]:
        found.append("error: training set is empty")
    if not n_val:
        found.append("error: validation set is empty")
    elif n_val < least_val:
        found.append(f"warning: validation set has {n_val} rows")
    for name in ("no_messages", "no_role", "no_content"):
        if counts[name]:
            found.append(f"error: {counts[name]} training rows with {name}")
    return found


def pass_rates(results: DataFrame, by: str) -> DataFrame:
    """total, passed, failed, pass_rate, seconds for each group of test results."""
    total, passed = F.count(F.lit(1)), F.count_if(F.col("passed"))
    return results.groupBy(by).agg(
        total.alias("total"),
        passed.alias("passed"),
        (total - passed).alias("failed"),
        (passed / total).alias("pass_rate"),
        F.sum("seconds").alias("seconds"),
    )


def first_failures(results: DataFrame, order: str, n: int = 10) -> DataFrame:
    """The first ``n`` results that did not pass (a report)."""
    return results.filter(~F.col("passed")).orderBy(order).limit(n)


def trainable_share(parameters: DataFrame) -> DataFrame:
    """n, trainable, share over rows (n, trainable)."""
    all_, on = F.sum("n"), F.sum(F.when(F.col("trainable"), F.col("n")).otherwise(0))
    return parameters.agg(all_.alias("n"), on.alias("trainable"), F.when(all_ > 0, on / all_).otherwise(0.0).alias("share"))


def below_thresholds(metrics: DataFrame, limits: dict[str, float]) -> DataFrame:
    """Rows (metric, value) that lie below their metric's limit (alarms)."""
    low = F.lit(False)
    for name, limit in limits.items():
        low = low | ((F.col("metric") == name) & (F.col("value") < limit))
    return metrics.filter(low)
