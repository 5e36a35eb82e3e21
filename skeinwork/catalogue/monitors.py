"""Queries of training monitors.

Runs: ``user_id`` of ``events`` modulo 40; steps: places in order of time; losses:
the absolute values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as tf
from ..functions import vectors as vf
from ..operators import monitor
from .tables import table


def _log(spark: SparkSession, sf_dir: str) -> DataFrame:
    run = (F.col("user_id") % 40).alias("run")
    e = table(spark, sf_dir, "events").select(run, "ts", "event_id", F.abs("value").alias("loss"))
    step = F.row_number().over(Window.partitionBy("run").orderBy("ts", "event_id"))
    return e.select("run", step.alias("step"), "loss", "event_id")


LOG = """log AS (SELECT user_id % 40 AS run, CAST(row_number() OVER (PARTITION BY user_id % 40 ORDER BY ts, event_id) AS INT) AS step,
  abs(value) AS loss, event_id FROM events),
sized AS (SELECT *, max(step) OVER (PARTITION BY run) AS n FROM log)"""


def e6_early_stop(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monitor.early_stopping(_log(spark, sf_dir)).select("run", "stop_step")


#: At threshold 0 the best so far is the running minimum.
E6 = f"""WITH {LOG}, b AS (SELECT *, min(loss) OVER (PARTITION BY run ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS best FROM log),
g AS (SELECT run, step, CAST(best IS NULL OR loss < best AS INT) AS better FROM b),
i AS (SELECT run, step, better, sum(better) OVER (PARTITION BY run ORDER BY step) AS island FROM g),
w AS (SELECT run, step, sum(1 - better) OVER (PARTITION BY run, island ORDER BY step) AS wait FROM i)
SELECT run, CAST(min(step) FILTER (WHERE wait >= 3) AS BIGINT) AS stop_step FROM w GROUP BY run"""


def e6_early_stop_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monitor.early_stopping(_log(spark, sf_dir), patience=4, threshold=5.0).select("run", "stop_step", F.round("best", 6).alias("best"))


E6T = f"""WITH RECURSIVE {LOG}, walk AS (
  SELECT run, step, loss AS best, 0 AS wait, CAST(NULL AS BIGINT) AS stop FROM log WHERE step = 1
  UNION ALL
  SELECT w.run, l.step, CASE WHEN w.stop IS NULL AND l.loss < w.best - 5.0 THEN l.loss ELSE w.best END,
    CASE WHEN w.stop IS NOT NULL THEN w.wait WHEN l.loss < w.best - 5.0 THEN 0 ELSE w.wait + 1 END,
    CASE WHEN w.stop IS NOT NULL THEN w.stop WHEN NOT l.loss < w.best - 5.0 AND w.wait + 1 >= 4 THEN CAST(l.step AS BIGINT) END
  FROM walk w JOIN log l ON l.run = w.run AND l.step = w.step + 1)
SELECT w.run, w.stop AS stop_step, round(w.best, 6) AS best FROM walk w JOIN (SELECT run, max(step) AS m FROM log GROUP BY run) AS x ON w.run = x.run AND w.step = x.m"""


def e7_nan_halt(spark: SparkSession, sf_dir: str) -> DataFrame:
    loss = F.when(F.col("event_id") % 97 == 0, F.lit(float("nan"))).when(F.col("event_id") % 89 == 0, F.lit(float("-inf"))).otherwise(F.col("loss"))
    return monitor.first_bad_loss(_log(spark, sf_dir).withColumn("loss", loss))


def t5_spikes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monitor.loss_spikes(_log(spark, sf_dir), factor=20.0)


def t6_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monitor.divergence(_log(spark, sf_dir), limit=300.0)


def t7_converging(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monitor.converging(_log(spark, sf_dir)).select("run", "converging")


def t8_plateau(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monitor.plateau(_log(spark, sf_dir), variance=500.0)


def t9_fit_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = _log(spark, sf_dir)
    return monitor.fit_trend(log.select("run", "step", F.col("loss").alias("train_loss"), (100 - F.col("loss")).alias("val_loss")), high=30.0)


T9 = f"""WITH {LOG} SELECT run, regr_slope(loss, step) < 0 AND regr_slope(100 - loss, step) > 0 AS overfit,
  avg(loss) > 30 AND avg(100 - loss) > 30 AS underfit FROM sized WHERE step > n - 3 GROUP BY run"""


def t12_gradients(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monitor.gradient_health(_log(spark, sf_dir), tiny=60.0, huge=300.0)


T12 = f"""WITH {LOG} SELECT run, bool_and(abs(loss) < 60) FILTER (WHERE step > n - 3) AS vanishing, bool_or(abs(loss) > 300) AS exploding FROM sized GROUP BY run"""


def t13_norms(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = F.col("embedding")
    return table(spark, sf_dir, "embeddings").select("vec_id", F.round(vf.norm(v), 6).alias("norm"))


def t13_label_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Largest over smallest squared norm within each label."""
    n = table(spark, sf_dir, "embeddings").select("label", vf.dot(F.col("embedding"), F.col("embedding")).alias("n"))
    return n.groupBy("label").agg(F.round(F.max("n") / F.min("n"), 4).alias("ratio"))


T13R = """WITH t AS (SELECT label, list_sum(list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE)) AS n FROM embeddings)
SELECT label, round(max(n) / min(n), 4) AS ratio FROM t GROUP BY label"""


def t14_schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    step = F.col("event_id")
    return table(spark, sf_dir, "events").select("event_id", F.round(monitor.warmup_cosine(step, 100, 1000, 2e-4) * 1e4, 6).alias("rate"))


T14 = """SELECT event_id, round((CASE WHEN event_id < 100 THEN 2e-4 * event_id / 100.0
  ELSE 1e-4 * (1 + cos((event_id - 100) / 900.0 * pi())) END) * 1e4, 6) AS rate FROM events"""


def t15_softmax(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = vf.softmax(F.col("embedding"), 0.5)
    rows = table(spark, sf_dir, "embeddings").select("vec_id", p.alias("p"))
    return rows.select("vec_id", F.round(F.array_max("p"), 6).alias("top"), F.array_position("p", F.array_max("p")).alias("place"))


T15 = """WITH t AS (SELECT vec_id, list_transform(embedding, lambda x: exp(x::DOUBLE / 0.5)) AS e FROM embeddings)
SELECT vec_id, round(list_max(e) / list_sum(e), 6) AS top, CAST(list_position(e, list_max(e)) AS BIGINT) AS place FROM t"""


def t16_best_checkpoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monitor.best_checkpoint(_log(spark, sf_dir))


T16 = f"""WITH {LOG} SELECT run, step, loss FROM (SELECT *, row_number() OVER (PARTITION BY run ORDER BY loss, step) AS r FROM log) AS t WHERE r = 1"""

_LINE = """concat('Epoch ', event_id, CASE event_id % 4 WHEN 0 THEN concat(' Train loss: ', CAST(event_id % 100 AS STRING), '.5')
  WHEN 1 THEN concat(' Avg student score: ', CAST(event_id % 10 AS STRING)) WHEN 2 THEN concat('Correction rate: ', CAST(event_id % 50 AS STRING), '.25% Corrections: ', event_id)
  ELSE ' nothing' END)"""


def e5_log_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "events").selectExpr("event_id", f"{_LINE} AS line")
    return lines.select("event_id", tf.log_metrics(F.col("line")).alias("m")).select("event_id", "m.*")


E5 = f"""WITH t AS (SELECT event_id, {_LINE} AS line FROM events) SELECT event_id,
  TRY_CAST(nullif(regexp_extract(line, 'Train loss: ([0-9\\.]+)', 1), '') AS DOUBLE) AS train_loss,
  TRY_CAST(nullif(regexp_extract(line, 'Avg student score: ([0-9\\.]+)', 1), '') AS DOUBLE) AS avg_student_score,
  TRY_CAST(nullif(regexp_extract(line, 'Correction rate: ([0-9\\.]+)%', 1), '') AS DOUBLE) AS correction_rate,
  TRY_CAST(nullif(regexp_extract(line, 'Corrections: ([0-9]+)', 1), '') AS DOUBLE) AS num_corrections FROM t"""


def e9_trainable(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "part").select(F.col("p_size").cast("long").alias("n"), (F.col("p_partkey") % 10 == 0).alias("trainable"))
    return monitor.trainable_share(rows).withColumn("share", F.round("share", 6))


def p2_thresholds(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select("event_id", F.col("event_type").alias("metric"), "value")
    return monitor.below_thresholds(rows, {"click": 1.0, "view": 2.0, "purchase": 5.0})


QUERIES = {f.__name__: f for f in (
    e5_log_metrics, e6_early_stop, e6_early_stop_threshold, e7_nan_halt, e9_trainable, t5_spikes, t6_divergence, t7_converging, t8_plateau,
    t9_fit_trend, t12_gradients, t13_norms, t13_label_ratio, t14_schedule, t15_softmax, t16_best_checkpoint, p2_thresholds,
)}
ORACLES = {
    "e5_log_metrics": E5,
    "e6_early_stop": E6,
    "e6_early_stop_threshold": E6T,
    "e7_nan_halt": f"WITH {LOG} SELECT run, min(step) FILTER (WHERE event_id % 97 = 0 OR event_id % 89 = 0) AS bad_step FROM log GROUP BY run",
    "e9_trainable": """SELECT CAST(sum(p_size) AS BIGINT) AS n, CAST(sum(p_size) FILTER (WHERE p_partkey % 10 = 0) AS BIGINT) AS trainable,
      round(sum(p_size) FILTER (WHERE p_partkey % 10 = 0) / sum(p_size), 6) AS share FROM part""",
    "t5_spikes": f"WITH {LOG}, s AS (SELECT run, step, loss > 20 * lag(loss) OVER (PARTITION BY run ORDER BY step) AS spike FROM log) SELECT run, min(step) FILTER (WHERE spike) AS spike_step FROM s GROUP BY run",
    "t6_divergence": f"WITH {LOG} SELECT run, bool_or(loss > 300) AS diverged FROM log GROUP BY run",
    "t7_converging": f"WITH {LOG} SELECT run, avg(loss) FILTER (WHERE step > n - 3) < avg(loss) FILTER (WHERE step <= 3) AS converging FROM sized GROUP BY run",
    "t8_plateau": f"WITH {LOG} SELECT run, max(n) > 3 AND var_pop(loss) FILTER (WHERE step > n - 3) < 500 AS plateau FROM sized GROUP BY run",
    "t9_fit_trend": T9,
    "t12_gradients": T12,
    "t13_norms": "SELECT vec_id, round(sqrt(list_sum(list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE))), 6) AS norm FROM embeddings",
    "t13_label_ratio": T13R,
    "t14_schedule": T14,
    "t15_softmax": T15,
    "t16_best_checkpoint": T16,
    "p2_thresholds": "SELECT event_id, event_type AS metric, value FROM events WHERE (event_type = 'click' AND value < 1) OR (event_type = 'view' AND value < 2) OR (event_type = 'purchase' AND value < 5)",
}
