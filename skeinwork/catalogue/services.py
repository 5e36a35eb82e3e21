"""Queries of batches through models and services, with deterministic stand-ins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import distill, inference, places
from ..plans import epoch
from ..plans.epoch import score_outputs
from ..schemas import CORRECTION
from ..sources.files import accumulated_corrections, append_metrics, read_prompts, write_corrections, write_single_json
from ..sources.fixed import CORRECTION_SYSTEM, EVAL_PROMPTS, SAMPLE_PROMPTS, TEACHER_SYSTEM
from . import distillation
from .tables import CODE_ROWS, code_rows, scratch, table

NOW = "2024-01-01T00:00:00"


def stand_in(prompt: str, system: str | None = None) -> dict:
    """A service that repeats what it was told first, and fails on some prompts."""
    if len(prompt) % 11 == 0:
        raise inference.ServiceError("AccessDenied", "no access")
    if len(prompt) % 13 == 0:
        return {"content": []}
    return {"content": [{"text": f"// {(system or '')[:19]}" + prompt[:10]}], "usage": {"input_tokens": len(prompt), "output_tokens": 7}}


def b2_sample_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Built-in prompts, and in which of the two lists they stand."""
    rows = [(i, p, "sample") for i, p in SAMPLE_PROMPTS] + [(i, p, "eval") for i, p in EVAL_PROMPTS]
    return spark.createDataFrame(rows, "id string, prompt string, kind string")


def b1_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prompts as they are read from JSON lines."""
    return read_prompts(spark, _prompt_file(spark, sf_dir))


def _prompt_file(spark: SparkSession, sf_dir: str) -> str:
    """User turns in order as JSON lines in one file; every fourth lacks its id."""
    path = scratch(spark, "prompts")
    c = table(spark, sf_dir, "conversations").filter("role = 'user'").orderBy("conv_id", "turn")
    named = F.when(F.col("turn") % 4 != 0, (F.col("conv_id") * 1000 + F.col("turn")).cast("string"))
    c.select(named.alias("id"), F.col("text").alias("prompt")).coalesce(1).write.json(path)
    return path


ASKED = """a AS (SELECT CASE WHEN turn % 4 <> 0 THEN CAST(conv_id * 1000 + turn AS VARCHAR) END AS id, text AS prompt,
  CAST(row_number() OVER (ORDER BY conv_id, turn) - 1 AS VARCHAR) AS place FROM conversations WHERE role = 'user')"""


def b6_default_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers to all prompts; one without an id goes by its place."""
    done = inference.generate(b1_prompts(spark, sf_dir), stand_in, NOW, workers=4, system=TEACHER_SYSTEM)
    return done.select("id", "success", "response")


def b6_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places and ids of prompts that come out of a join, whose partitions no two plans need share."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels").select("doc_id")
    prompts = docs.join(labels.hint("shuffle_hash"), "doc_id").filter("text <> ''").select(F.col("text").alias("prompt"))
    ids = inference.generate(prompts, stand_in, NOW, workers=4).select(F.lit("ids").alias("what"), "id")
    both = places.numbered(prompts, "at").select(F.lit("places").alias("what"), F.col("at").cast("string").alias("id")).unionByName(ids)
    last = F.max(F.col("id").cast("long")).alias("last")
    return both.groupBy("what").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("id").alias("n_ids"), last)


def b5_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch that is asked for in part, and then as a whole: the first answers stay, failures are asked for again."""
    path, prompts = scratch(spark, "answers"), _prompts(spark, sf_dir)
    inference.generate_once(prompts.filter("CAST(id AS long) % 3 = 0"), stand_in, "first", path, every=40, workers=2)
    done = inference.generate_once(prompts, stand_in, "then", path, every=500, workers=2)
    return done.select("id", "response", "success", "timestamp")


def b3_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    attempt = (F.col("event_id") % 6).alias("attempt")
    return table(spark, sf_dir, "events").select(attempt).distinct().select("attempt", inference.backoff(0.1, F.col("attempt")).alias("delay"))


def _prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations").filter("role = 'user'")
    text = F.when(F.col("conv_id") % 10 == 0, F.lit("")).otherwise(F.col("text"))
    return c.select((F.col("conv_id") * 1000 + F.col("turn")).cast("string").alias("id"), text.alias("prompt"))


def b3b_infer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With the teacher's system prompt, of which the stand-in repeats the beginning."""
    done = inference.generate(_prompts(spark, sf_dir), stand_in, NOW, workers=4, system=TEACHER_SYSTEM)
    return done.select("id", "response", "success", "error", "usage.output_tokens", "timestamp")


_TOLD = TEACHER_SYSTEM[:19].replace("'", "''")
PROMPTS = "p AS (SELECT CAST(conv_id * 1000 + turn AS VARCHAR) AS id, text, length(text) AS n FROM conversations WHERE role = 'user' AND conv_id % 10 <> 0)"
DONE = f"""{PROMPTS}, done AS (SELECT id, CASE WHEN n % 11 <> 0 AND n % 13 <> 0 THEN '// {_TOLD}' || substr(text, 1, 10) END AS response,
  n % 11 <> 0 AND n % 13 <> 0 AS success, CASE WHEN n % 11 = 0 THEN 'no access' WHEN n % 13 = 0 THEN 'Empty response' END AS error,
  CASE WHEN n % 11 <> 0 AND n % 13 <> 0 THEN CAST(7 AS BIGINT) END AS output_tokens FROM p)"""


def b4_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inference.batch_summary(inference.generate(_prompts(spark, sf_dir), stand_in, NOW, workers=4))


def b7_sorted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ids in the order of their text."""
    return inference.by_text_id(table(spark, sf_dir, "events").select(F.col("event_id").alias("id")))


_BODY = """CASE event_id % 3 WHEN 0 THEN concat('{"content":[{"text":"answer ', event_id, '"}],"usage":{"input_tokens":1,"output_tokens":', event_id % 9, '}}')
  WHEN 1 THEN '{"content":[]}' ELSE '{"content":[{"text":"x"}]}' END"""


def p1_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    bodies = table(spark, sf_dir, "events").selectExpr("event_id", f"{_BODY} AS body")
    parsed = bodies.select("event_id", inference.parse_body(F.col("body")).alias("p"))
    return parsed.select("event_id", "p.response", "p.success", F.coalesce("p.usage.output_tokens", F.lit(0)).alias("output_tokens"))


P1 = """SELECT event_id, CASE event_id % 3 WHEN 0 THEN 'answer ' || event_id WHEN 2 THEN 'x' END AS response, event_id % 3 <> 1 AS success,
  CASE event_id % 3 WHEN 0 THEN event_id % 9 ELSE 0 END AS output_tokens FROM events"""


def correct(prompt: str, system: str | None = None) -> dict:
    """A teacher whose answer tells what it was asked; on some prompts it has none."""
    if len(prompt) % 7 == 0:
        return {"content": []}
    return {"content": [{"text": f"{(system or '')[:12]} {len(prompt)}"}]}


def _poor(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = distillation._scored(spark, sf_dir).select(F.col("n").cast("string").alias("id"), "prompt", "output", "score")
    return scored.filter("score < 8.5")


def d4_corrections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Corrections of every turn under the threshold, each answer asked for once."""
    fixed = inference.corrections(_poor(spark, sf_dir), correct, 3, NOW, workers=2, path=scratch(spark, "answers"))
    return fixed.select("id", F.md5("original_prompt").alias("prompt"), "student_score", "teacher_correction", "epoch")


def d10_corrections_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two epochs' corrections as JSON lines, accumulated; the second epoch's are written twice."""
    folder, poor = scratch(spark, "corrections"), _poor(spark, sf_dir)
    for epoch in (1, 2, 2):
        made = inference.corrections(poor.filter(F.length("output") % 2 == epoch - 1), correct, epoch, NOW, workers=2)
        own = write_corrections(made, folder, epoch)
    kept = spark.read.schema(CORRECTION).json(accumulated_corrections(folder)).unionByName(own.withColumn("epoch", F.lit(0)))
    return kept.groupBy("epoch").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("id").alias("n_ids"), F.sum(F.size("messages")).cast("long").alias("n_messages"))


D4 = f"""WITH {distillation.SCORED}, poor AS (SELECT n, prompt, output, score, length('{distill.CORRECTION_HEAD.replace("'", "''")}' || prompt || '{distill.CORRECTION_SCORED}' ||
  printf('%.1f', score) || '{distill.CORRECTION_OUTPUT}' || output || '{distill.CORRECTION_TAIL.replace("'", "''")}') AS chars FROM scored WHERE score < 8.5),
fixed AS (SELECT * FROM poor WHERE chars % 7 <> 0)"""
_CORRECT = CORRECTION_SYSTEM[:12].replace("'", "''")


def d9_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics of all runs' epochs, appended epoch by epoch of the first three, the second twice, and read again."""
    path, checked = scratch(spark, "metrics"), distillation._checked(spark, sf_dir)
    for epoch in (1, 2, 3, 2):
        append_metrics(checked.filter(F.col("epoch") == epoch).select("run", "epoch", "reason"), path, f"epoch_{epoch}")
    return spark.read.schema("run long, epoch int, reason string").json(path).select("run", "epoch", "reason")


def d11_summary_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The summary of one run as a JSON file."""
    path = scratch(spark, "summary")
    summary = distill.run_summary(distillation._checked(spark, sf_dir)).filter("run = 7")
    write_single_json(summary.select("run", "total_epochs", "total_corrections", "converged", "reason"), path)
    return spark.read.schema("run long, total_epochs long, total_corrections long, converged boolean, reason string").json(path)


def d17_evaluated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The prompts that an epoch evaluates (the first 20, as the feature asks)."""
    return epoch.evaluated(table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("id"), F.col("text").alias("prompt")), 20, "id")


def q0_outputs_by_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prompts with the outputs of their ids, whatever the order of either."""
    turns = table(spark, sf_dir, "conversations")
    prompts = turns.filter("role = 'user'").select((F.col("conv_id") * 1000 + F.col("turn") + 1).alias("id"), F.col("text").alias("prompt"))
    outputs = turns.filter("role = 'assistant'").select((F.col("conv_id") * 1000 + F.col("turn")).alias("id"), F.col("text").alias("output"))
    return epoch.with_outputs(prompts, outputs.orderBy(F.desc("id")))


def q4_compiled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole scores with the executors' C compiler in place of the syntax rules."""
    outputs = code_rows(spark, sf_dir).select("id", "prompt", F.col("code").alias("output"))
    return score_outputs(outputs, compiler=True).select("id", F.col("quality.syntax").alias("syntax"), F.round("score", 6).alias("score"))


def stub_check(units: list[str]) -> list[tuple[bool, str] | None]:
    """A stand-in for a compiler: an error for each open call, a warning for each jump."""
    said = ["x.c:1: error: unbalanced\n" * u.count("(unbalanced") + "x.c:2: warning: jump\n" * u.count("goto ") for u in units]
    return [("error:" not in x, x) for x in said]


def q4_checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Syntax scores by a stand-in compiler; every code comes three times, some blank, and is checked once."""
    rows = code_rows(spark, sf_dir).select("id", F.when(F.col("id") % 10 != 0, F.col("code")).otherwise(F.lit(" ")).alias("code"))
    thrice = rows.select(F.explode(F.array(*[F.lit(i) for i in range(3)])).alias("copy"), "id", "code")
    return inference.compiled(thrice, "code", "syntax", stub_check).select("copy", "id", "syntax")


Q4C = f"""WITH c AS ({CODE_ROWS}) SELECT copy, id, CAST(CASE WHEN id % 10 = 0 THEN 0 WHEN contains(code, '(unbalanced') THEN 4 WHEN contains(code, 'goto ') THEN 8.5 ELSE 10 END AS DOUBLE) AS syntax
  FROM c CROSS JOIN (VALUES (0), (1), (2)) AS t(copy)"""


def t11_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    bodies = table(spark, sf_dir, "events").selectExpr("event_id", "event_type", f"{_BODY} AS body")
    usage = bodies.select("event_type", inference.parse_body(F.col("body"))["usage"].alias("u"))
    return usage.groupBy("event_type").agg(F.sum(F.coalesce("u.output_tokens", F.lit(0))).alias("output_tokens"))


QUERIES = {f.__name__: f for f in (
    b1_prompts, b2_sample_prompts, b3_backoff, b3b_infer, b4_summary, b5_stored, b6_default_ids, b6_places, b7_sorted, p1_parse, d4_corrections,
    d9_metrics, d10_corrections_files, d11_summary_json, d17_evaluated, q0_outputs_by_id, q4_compiled, q4_checked, t11_usage,
)}
_LISTED = ", ".join("('%s', '%s', '%s')" % (i, p.replace("'", "''"), kind) for kind, listed in (("sample", SAMPLE_PROMPTS), ("eval", EVAL_PROMPTS)) for i, p in listed)
_HALVES = f"""{D4}, h AS (SELECT CASE WHEN length(output) % 2 = 0 THEN 1 ELSE 2 END AS epoch FROM fixed)"""
ORACLES = {
    "b1_prompts": f"WITH {ASKED} SELECT id, prompt FROM a",
    "b2_sample_prompts": f"SELECT * FROM (VALUES {_LISTED}) AS t(id, prompt, kind)",
    "b5_stored": f"""WITH {DONE} SELECT id, replace(response, '{_TOLD}', '') AS response, success, CASE WHEN success AND CAST(id AS BIGINT) % 3 = 0 THEN 'first' ELSE 'then' END AS timestamp FROM done""",
    "b6_places": """SELECT what, n, n AS n_ids, n - 1 AS last FROM (SELECT count(*) AS n FROM documents d JOIN labels l ON l.doc_id = d.doc_id WHERE d.text <> '')
      CROSS JOIN (VALUES ('places'), ('ids')) AS t(what)""",
    "b6_default_ids": f"""WITH {ASKED} SELECT coalesce(id, place) AS id, length(prompt) % 11 <> 0 AND length(prompt) % 13 <> 0 AS success,
      CASE WHEN length(prompt) % 11 <> 0 AND length(prompt) % 13 <> 0 THEN '// {_TOLD}' || substr(prompt, 1, 10) END AS response FROM a WHERE prompt <> ''""",
    "b3_backoff": "SELECT DISTINCT event_id % 6 AS attempt, 0.1::DOUBLE * pow(2, event_id % 6) AS delay FROM events",
    "b3b_infer": f"WITH {DONE} SELECT id, response, success, error, output_tokens, '{NOW}' AS timestamp FROM done",
    "b4_summary": f"WITH {DONE} SELECT count(*) AS total, count(*) FILTER (WHERE success) AS successful, count(*) FILTER (WHERE NOT success) AS failed, CAST(coalesce(sum(output_tokens), 0) AS BIGINT) AS output_tokens FROM done",
    "b7_sorted": "SELECT event_id AS id FROM events ORDER BY CAST(event_id AS VARCHAR)",
    "p1_parse": P1,
    "d4_corrections": f"""{D4} SELECT n || '_correction_e3' AS id, md5(prompt) AS prompt, score AS student_score, '{_CORRECT} ' || chars AS teacher_correction, 3 AS epoch FROM fixed""",
    "d9_metrics": f"WITH {distillation.EPOCHS}, {distillation.CHECKED} SELECT run, epoch, reason FROM checked WHERE epoch <= 3",
    "d10_corrections_files": f"""{_HALVES} SELECT epoch, count(*) * epoch AS n, count(*) AS n_ids, CAST(count(*) * 2 * epoch AS BIGINT) AS n_messages FROM h GROUP BY epoch
      UNION ALL SELECT 0, count(*), count(*), CAST(count(*) * 2 AS BIGINT) FROM h WHERE epoch = 2""",
    "d11_summary_json": f"""WITH {distillation.EPOCHS}, {distillation.CHECKED} SELECT run, count(*) AS total_epochs, CAST(sum(n_corrections) AS BIGINT) AS total_corrections,
      arg_max(reason IN ('score', 'rate'), epoch) AS converged, arg_max(reason, epoch) AS reason FROM checked WHERE run = 7 GROUP BY run""",
    "d17_evaluated": "SELECT item_id AS id, text AS prompt FROM benchmark ORDER BY item_id LIMIT 20",
    "q0_outputs_by_id": """SELECT u.conv_id * 1000 + u.turn + 1 AS id, u.text AS prompt, a.text AS output FROM conversations u JOIN conversations a
      ON a.conv_id = u.conv_id AND a.turn = u.turn + 1 WHERE u.role = 'user' AND a.role = 'assistant'""",
    "q4_checked": Q4C,
    "t11_usage": "SELECT event_type, CAST(sum(CASE event_id % 3 WHEN 0 THEN event_id % 9 ELSE 0 END) AS BIGINT) AS output_tokens FROM events GROUP BY event_type",
}
