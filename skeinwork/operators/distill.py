"""Analytics of teacher-student correction rounds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

QUALITY_THRESHOLD, CONVERGED_SCORE, PATIENCE, MAX_CORRECTIONS, LOW_RATE = 7.0, 8.0, 3, 500, 0.10

#: What a teacher is asked and told.
CORRECTION_HEAD = "A student model was asked to generate automotive embedded code for the following prompt:\n\n<prompt>\n"
CORRECTION_SCORED = "\n</prompt>\n\nThe student produced this output (scored "
CORRECTION_OUTPUT = "/10):\n\n<student_output>\n"
CORRECTION_TAIL = """
</student_output>

Please provide a corrected, production-quality version that:
1. Fixes any errors or bugs in the student's code
2. Follows MISRA-C guidelines for safety-critical automotive code
3. Includes proper error handling and return codes
4. Uses correct data types (uint8_t, uint32_t, etc.)
5. Is suitable for embedded automotive systems (TSN/AVB)

Provide ONLY the corrected code with appropriate comments. No explanations outside the code."""


def one_decimal(x: Column) -> Column:
    """A number from 0 on as text with one decimal, rounded as its exact binary value asks.

    Twenty times the number is compared with the odd number that stands for the middle
    between two decimals; in two steps, each of which is exact near that middle.
    """
    tenths = F.floor(x * 10)
    middle = tenths * 2 + 1
    off = (x * 16 - middle) + x * 4
    up = (off > 0) | ((off == 0) & (tenths % 2 == 1))
    rounded = (tenths + up.cast("int")).cast("long")
    return F.format_string("%d.%d", F.floor(rounded / 10), rounded % 10)


def correction_prompt(prompt: Column, output: Column, score: Column) -> Column:
    return F.concat(
        F.lit(CORRECTION_HEAD), prompt, F.lit(CORRECTION_SCORED), one_decimal(score), F.lit(CORRECTION_OUTPUT), output, F.lit(CORRECTION_TAIL)
    )


def worst(scored: DataFrame, order: str, threshold: float = QUALITY_THRESHOLD, k: int = MAX_CORRECTIONS) -> DataFrame:
    """The ``k`` lowest scores under the threshold; ties in the order of ``order``."""
    return scored.filter(F.col("score") < threshold).orderBy("score", order).limit(k)


def score_summary(scored: DataFrame, threshold: float = QUALITY_THRESHOLD, cap: int = MAX_CORRECTIONS) -> DataFrame:
    """n, avg_score, the four histogram buckets, n_poor (capped), correction_rate: one row."""
    s = F.col("score")
    n = F.count(F.lit(1))
    poor = F.least(F.count_if(s < threshold), F.lit(cap))
    return scored.agg(
        n.alias("n"),
        F.coalesce(F.avg(s), F.lit(0.0)).alias("avg_score"),
        F.count_if(s < 5).alias("below_5"),
        F.count_if((s >= 5) & (s < 7)).alias("from_5_to_7"),
        F.count_if((s >= 7) & (s < 9)).alias("from_7_to_9"),
        F.count_if(s >= 9).alias("above_9"),
        poor.alias("n_poor"),
        F.when(n > 0, poor / n).otherwise(0.0).alias("correction_rate"),
    )


def convergence(epochs: DataFrame, run: str = "run", score: float = CONVERGED_SCORE, patience: int = PATIENCE) -> DataFrame:
    """``epochs`` (run, epoch, avg_score, rate) with streak, best_score, converged, reason.

    streak: epochs in a row at the score; it starts again after a miss.
    """
    order = Window.partitionBy(run).orderBy("epoch")
    so_far = order.rowsBetween(Window.unboundedPreceding, 0)
    recent = order.rowsBetween(-(patience - 1), 0)
    hit = F.col("avg_score") >= score
    marked = epochs.withColumn("__hit", hit.cast("int")).withColumn("__miss", F.sum(1 - hit.cast("int")).over(so_far))
    island = Window.partitionBy(run, "__miss").orderBy("epoch").rowsBetween(Window.unboundedPreceding, 0)
    streaked = (
        marked.withColumn("streak", F.sum("__hit").over(island))
        .withColumn("best_score", F.greatest(F.lit(0.0), F.max("avg_score").over(so_far)))
        .withColumn("__n", F.count(F.lit(1)).over(so_far))
        .withColumn("__rate", F.max("rate").over(recent))
    )
    reason = (
        F.when(F.col("__n") < patience, "not enough epochs")
        .when(F.col("streak") >= patience, "score")
        .when(F.col("__rate") < LOW_RATE, "rate")
        .otherwise("in progress")
    )
    return (
        streaked.withColumn("reason", reason)
        .withColumn("converged", F.col("reason").isin("score", "rate"))
        .drop("__hit", "__miss", "__n", "__rate")
    )


def stop_at_convergence(checked: DataFrame, max_epochs: int, run: str = "run") -> DataFrame:
    """Epochs that are run: up to the first converged one, and ``max_epochs`` at most."""
    first = F.min(F.when(F.col("converged"), F.col("epoch"))).over(Window.partitionBy(run))
    last = F.least(F.coalesce("__first", F.lit(max_epochs)), F.lit(max_epochs))
    return checked.withColumn("__first", first).filter(F.col("epoch") <= last).drop("__first")


def run_summary(checked: DataFrame, run: str = "run") -> DataFrame:
    """First and last values, the best and totals of each run."""
    return checked.groupBy(run).agg(
        F.count(F.lit(1)).alias("total_epochs"),
        F.max_by("avg_score", "epoch").alias("final_avg_score"),
        F.greatest(F.lit(0.0), F.max("avg_score")).alias("best_avg_score"),
        F.sum("n_corrections").alias("total_corrections"),
        F.min_by("rate", "epoch").alias("initial_rate"),
        F.max_by("rate", "epoch").alias("final_rate"),
        F.max_by("converged", "epoch").alias("converged"),
        F.max_by("reason", "epoch").alias("reason"),
    )


def append_corrections(training: DataFrame, corrections: DataFrame) -> DataFrame:
    """The next epoch's training set: messages of both."""
    return training.select("messages").unionByName(corrections.select("messages"))
