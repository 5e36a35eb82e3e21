"""Queries of correction rounds: scores of turns, convergence of runs.

Runs: ``user_id`` of ``events``; epochs: days, numbered; the average score is the
day's mean value on a scale to 10, the rate the share of its low values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.scoring import quality
from ..functions.text import code_block
from ..operators import distill
from . import scoring
from .tables import table


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Assistant turns scored against the turn before: id, n (order), prompt, output, score."""
    turns = table(spark, sf_dir, "conversations")
    before = F.lag("text").over(Window.partitionBy("conv_id").orderBy("turn"))
    pairs = turns.withColumn("prompt", before).filter("role = 'assistant' and prompt is not null")
    score = F.round(quality(code_block(F.col("text")), F.col("prompt"))["overall"], 6)
    n = F.col("conv_id") * 1000 + F.col("turn")
    return pairs.select(n.alias("n"), "prompt", F.col("text").alias("output"), score.alias("score"))


SCORED = f"""pairs AS (SELECT * FROM (SELECT conv_id * 1000 + turn AS n, role, text AS output,
    lag(text) OVER (PARTITION BY conv_id ORDER BY turn) AS prompt FROM conversations) AS t WHERE role = 'assistant' AND prompt IS NOT NULL),
scored AS (SELECT n, prompt, output, round(CAST({scoring.OVERALL} AS DOUBLE), 6) AS score
  FROM (SELECT n, prompt, output, output AS code FROM pairs) AS t)"""


def d1_worst_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distill.worst(_scored(spark, sf_dir), "n", 8.5, 25).select("n", "score")


def d2_correction_prompt(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = _scored(spark, sf_dir)
    asked = distill.correction_prompt(F.col("prompt"), F.col("output"), F.col("score"))
    return scored.select("n", F.md5(asked).alias("digest"))


D2 = f"""WITH {SCORED} SELECT n, md5('{distill.CORRECTION_HEAD.replace("'", "''")}' || prompt || '{distill.CORRECTION_SCORED}' ||
  printf('%.1f', score) || '{distill.CORRECTION_OUTPUT}' || output || '{distill.CORRECTION_TAIL.replace("'", "''")}') AS digest FROM scored"""


def d5_average(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distill.score_summary(_scored(spark, sf_dir)).select("n", F.round("avg_score", 6).alias("avg_score"))


def d6_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distill.score_summary(_scored(spark, sf_dir)).select("below_5", "from_5_to_7", "from_7_to_9", "above_9")


def d7_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distill.score_summary(_scored(spark, sf_dir), threshold=8.5, cap=20).select("n_poor", F.round("correction_rate", 6).alias("correction_rate"))


def _epochs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """run (user_id modulo 40), epoch (day from 1), avg_score, rate, n_corrections."""
    e = table(spark, sf_dir, "events").select(
        (F.col("user_id") % 40).alias("run"), F.to_date("ts").alias("day"), (F.abs(F.col("value")) % 10).alias("v")
    )
    days = e.groupBy("run", "day").agg(
        F.round(F.avg("v"), 6).alias("avg_score"), F.count_if(F.col("v") < 1).alias("low"), F.count(F.lit(1)).alias("n")
    )
    numbered = days.withColumn("epoch", F.row_number().over(Window.partitionBy("run").orderBy("day")))
    return numbered.select("run", "epoch", "avg_score", (F.col("low") / F.col("n")).alias("rate"), F.col("low").alias("n_corrections"))


EPOCHS = """days AS (SELECT user_id % 40 AS run, CAST(ts AS DATE) AS day, round(avg(abs(value) % 10), 6) AS avg_score,
    count(*) FILTER (WHERE abs(value) % 10 < 1) AS low, count(*) AS n FROM events GROUP BY user_id % 40, CAST(ts AS DATE)),
epochs AS (SELECT run, CAST(row_number() OVER (PARTITION BY run ORDER BY day) AS INT) AS epoch, avg_score, low / n AS rate, low AS n_corrections FROM days)"""
CHECKED = """hits AS (SELECT *, CAST(avg_score >= 5.0 AS INT) AS hit,
    sum(CAST(avg_score < 5.0 AS INT)) OVER (PARTITION BY run ORDER BY epoch) AS island FROM epochs),
streaks AS (SELECT *, CAST(sum(hit) OVER (PARTITION BY run, island ORDER BY epoch) AS BIGINT) AS streak,
    greatest(0.0, max(avg_score) OVER (PARTITION BY run ORDER BY epoch)) AS best_score,
    max(rate) OVER (PARTITION BY run ORDER BY epoch ROWS 2 PRECEDING) AS worst_rate FROM hits),
checked AS (SELECT *, CASE WHEN epoch < 3 THEN 'not enough epochs' WHEN streak >= 3 THEN 'score' WHEN worst_rate < 0.1 THEN 'rate' ELSE 'in progress' END AS reason FROM streaks)"""


def _checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distill.convergence(_epochs(spark, sf_dir), score=5.0)


def d13_streak(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _checked(spark, sf_dir).select("run", "epoch", "streak")


def d14_convergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _checked(spark, sf_dir).select("run", "epoch", "converged", "reason")


def d15_stop_epoch(spark: SparkSession, sf_dir: str) -> DataFrame:
    stopped = distill.stop_at_convergence(_checked(spark, sf_dir), 20)
    return stopped.groupBy("run").agg(F.max("epoch").alias("last_epoch"))


def d16_running_best(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _checked(spark, sf_dir).select("run", "epoch", "best_score")


def d8_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    summary = distill.run_summary(_checked(spark, sf_dir))
    return summary.select("*", F.round("initial_rate", 6).alias("r0"), F.round("final_rate", 6).alias("r1")).drop("initial_rate", "final_rate")


D8 = f"""WITH {EPOCHS}, {CHECKED} SELECT run, count(*) AS total_epochs, arg_max(avg_score, epoch) AS final_avg_score, max(best_score) AS best_avg_score,
  CAST(sum(n_corrections) AS BIGINT) AS total_corrections, round(arg_min(rate, epoch), 6) AS r0, round(arg_max(rate, epoch), 6) AS r1,
  arg_max(reason IN ('score', 'rate'), epoch) AS converged, arg_max(reason, epoch) AS reason FROM checked GROUP BY run"""


def d12_test_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators.monitor import pass_rates

    results = table(spark, sf_dir, "events").select("event_type", (F.col("value") > 30).alias("passed"), F.abs("value").alias("seconds"))
    rates = pass_rates(results, "event_type")
    return rates.withColumn("pass_rate", F.round("pass_rate", 6)).withColumn("seconds", F.round("seconds", 3))


D12 = """SELECT event_type, count(*) AS total, count(*) FILTER (WHERE value > 30) AS passed, count(*) FILTER (WHERE NOT value > 30) AS failed,
  round(count(*) FILTER (WHERE value > 30) / count(*), 6) AS pass_rate, round(sum(abs(value)), 3) AS seconds FROM events GROUP BY event_type"""


def d18_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The next training set: user and assistant turns, and corrections of the worst."""
    scored = _scored(spark, sf_dir)
    pair = lambda answer: F.array(F.struct(F.lit("user").alias("role"), F.col("prompt").alias("content")), F.struct(F.lit("assistant").alias("role"), answer.alias("content")))
    training = scored.select(pair(F.col("output")).alias("messages"))
    fixed = distill.worst(scored, "n", 8.5, 25).select(pair(F.concat(F.lit("fixed: "), F.col("output"))).alias("messages"))
    both = distill.append_corrections(training, fixed)
    return both.select(F.md5(F.col("messages")[1]["content"]).alias("digest"), F.size("messages").alias("n_messages"))


D18 = f"""WITH {SCORED} SELECT md5(output) AS digest, 2 AS n_messages FROM scored
UNION ALL SELECT md5('fixed: ' || output), 2 FROM (SELECT * FROM scored WHERE score < 8.5 ORDER BY score, n LIMIT 25) AS t"""

QUERIES = {f.__name__: f for f in (
    d1_worst_k, d2_correction_prompt, d5_average, d6_histogram, d7_rate, d8_summary, d12_test_rollup, d13_streak, d14_convergence,
    d15_stop_epoch, d16_running_best, d18_append,
)}
ORACLES = {
    "d1_worst_k": f"WITH {SCORED} SELECT n, score FROM scored WHERE score < 8.5 ORDER BY score, n LIMIT 25",
    "d2_correction_prompt": D2,
    "d5_average": f"WITH {SCORED} SELECT count(*) AS n, round(coalesce(avg(score), 0), 6) AS avg_score FROM scored",
    "d6_histogram": f"""WITH {SCORED} SELECT count(*) FILTER (WHERE score < 5) AS below_5, count(*) FILTER (WHERE score >= 5 AND score < 7) AS from_5_to_7,
      count(*) FILTER (WHERE score >= 7 AND score < 9) AS from_7_to_9, count(*) FILTER (WHERE score >= 9) AS above_9 FROM scored""",
    "d7_rate": f"""WITH {SCORED} SELECT least(count(*) FILTER (WHERE score < 8.5), 20) AS n_poor,
      round(least(count(*) FILTER (WHERE score < 8.5), 20) / count(*), 6) AS correction_rate FROM scored""",
    "d8_summary": D8,
    "d12_test_rollup": D12,
    "d13_streak": f"WITH {EPOCHS}, {CHECKED} SELECT run, epoch, streak FROM checked",
    "d14_convergence": f"WITH {EPOCHS}, {CHECKED} SELECT run, epoch, reason IN ('score', 'rate') AS converged, reason FROM checked",
    "d15_stop_epoch": f"""WITH {EPOCHS}, {CHECKED}, f AS (SELECT *, min(CASE WHEN reason IN ('score', 'rate') THEN epoch END) OVER (PARTITION BY run) AS first FROM checked)
      SELECT run, max(epoch) AS last_epoch FROM f WHERE epoch <= least(coalesce(first, 20), 20) GROUP BY run""",
    "d16_running_best": f"WITH {EPOCHS}, {CHECKED} SELECT run, epoch, best_score FROM checked",
    "d18_append": D18,
}
