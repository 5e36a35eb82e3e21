"""One correction round: score, summarise, choose the worst, correct, append."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scoring import quality
from ..functions.text import code_block
from ..operators import distill, inference
from ..sources.files import write_corrections


def score_outputs(outputs: DataFrame, compiler: bool = False, check: inference.Check = inference.compile_units) -> DataFrame:
    """``outputs`` (id, prompt, output) with ``quality`` and ``score``.

    With ``compiler`` the syntax score is that of ``check``, the executors' C compiler.
    """
    code = outputs.withColumn("__code", code_block(F.col("output")))
    if compiler:
        code = inference.compiled(code, "__code", "__syntax", check)
    syntax = F.col("__syntax") if compiler else None
    scored = code.withColumn("quality", quality(F.col("__code"), F.col("prompt"), syntax)).withColumn("score", F.col("quality.overall"))
    return scored.drop("__code", "__syntax")


def evaluated(prompts: DataFrame, n: int, order: str) -> DataFrame:
    """The first ``n`` prompts in order, which an epoch evaluates."""
    return prompts.orderBy(order).limit(n)


def with_outputs(prompts: DataFrame, outputs: DataFrame) -> DataFrame:
    """id, prompt, output of the prompts that have an output: matched by id, never by place."""
    return prompts.select("id", "prompt").join(outputs.select("id", "output"), "id")


def run_epoch(
    outputs: DataFrame, training: DataFrame, client: inference.Client, epoch: int, now: str, folder: str, compiler: bool = False
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(summary, corrections, next training set).

    The teacher's answers and the corrections are stored below ``folder``, and read
    from there, so no later action asks the teacher again.
    """
    scored = score_outputs(outputs, compiler)
    poor = distill.worst(scored, "id")
    made = inference.corrections(poor, client, epoch, now, path=f"{folder}/epoch_{epoch}_answers.jsonl")
    fixed = write_corrections(made, folder, epoch)
    return distill.score_summary(scored), fixed, distill.append_corrections(training, fixed)
