"""From code files to training examples: functions, prompts, completions."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import strip
from ..schemas import MESSAGES

#: Fixed value: the head of a C function up to its opening brace.
FUNCTION_HEAD = r"(?:static\s+)?(?:inline\s+)?(?:const\s+)?(\w+(?:\s*\*)*)\s+(\w+)\s*\(([^)]*)\)\s*\{"
#: Fixed value: what examples name as their source.
EXAMPLE_SOURCE = "automotive_codebase"
#: Control words that the head also fits, as in ``else if (x) {``.
CONTROL_WORDS = ["if", "for", "while", "switch", "return", "sizeof"]
MIN_BODY = 50
MIN_COMPLETION = 200
FUNCTIONS = "array<struct<name:string,return_type:string,params:string,body:string,lines:int>>"
#: A head that fits from within a word fits from the word's start too, unless it begins
#: with one of the leading words; so other places in words need not be tried.
_HEAD = re.compile(r"(?:(?<!\w)|(?=(?:static|inline|const)\s))" + FUNCTION_HEAD)
_BRACE = re.compile(r"[{}]")


def _closing(code: str) -> dict[int, int]:
    """The place after the closing brace of each opening one, in one pass."""
    found, open_ = {}, []
    for m in _BRACE.finditer(code):
        if m[0] == "{":
            open_.append(m.start())
        elif open_:
            found[open_.pop()] = m.end()
    return found


def functions_of(code: str | None, strict: bool = False) -> list[dict]:
    """The functions of one text; see ``functions_in``."""
    heads = list(_HEAD.finditer(code or ""))
    closing = _closing(code) if heads else {}
    out = []
    for m in heads:
        body = code[m.start() : closing.get(m.end() - 1, len(code))]
        if len(body) >= MIN_BODY and not (strict and m[2] in CONTROL_WORDS):
            parts = {"name": m[2], "return_type": m[1], "params": m[3]}
            out.append({k: v.strip() for k, v in parts.items()} | {"body": body, "lines": body.count("\n")})
    return out


def functions_in(code: Column, strict: bool = False) -> Column:
    """array<struct<name, return_type, params, body, lines>> of the functions in a text.

    Heads are found in order; a body runs from its head to the brace that closes it,
    or to the end of the text.  Braces in strings and comments count.  Bodies under
    50 characters are left out.  ``strict`` also leaves out control statements.  Braces
    are matched in one pass over the text, whatever the number of functions, which
    Spark's array functions could only do with a copy of the text for each.
    """

    @F.pandas_udf(FUNCTIONS)
    def found(codes: pd.Series) -> pd.Series:
        return pd.Series([functions_of(c, strict) for c in codes])

    return found(code)


def extract_functions(files: DataFrame, code: str = "code", strict: bool = False) -> DataFrame:
    """The rows of ``files`` with at least one function, once for each: name, ..., lines, ordinal."""
    listed = files.select("*", F.posexplode(functions_in(F.col(code), strict)).alias("ordinal", "__f"))
    return listed.select("*", "__f.*").drop("__f")


def _pick(seed: int, n: int, *key: Column) -> Column:
    """A number from 0 to n - 1 that depends on the seed and the key only."""
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), *[k.cast("string") for k in key]))
    return F.pmod(F.conv(F.substring(digest, 1, 8), 16, 10).cast("long"), F.lit(n)).cast("int")


def function_prompt(name: Column, ret: Column, params: Column, context: Column, choice: Column) -> Column:
    """One of four prompt forms, by ``choice`` (0 to 3); a context that is not empty is named.

    The four forms are fixed values.
    """
    forms = [
        F.concat(F.lit("Generate a C function named '"), name, F.lit("' that returns "), ret, F.lit(" with parameters ("), params, F.lit(")")),
        F.concat(F.lit("Implement the function '"), name, F.lit("' for automotive embedded systems")),
        F.concat(F.lit("Write C code for the '"), name, F.lit("' function used in "), context),
        F.concat(F.lit("Create an implementation of '"), name, F.lit("' following automotive coding standards")),
    ]
    chosen = F.element_at(F.array(*forms), choice + 1)
    return F.when(context != "", F.concat(chosen, F.lit(". Context: "), context)).otherwise(chosen)


def _messages(user: Column, assistant: Column) -> Column:
    turn = lambda role, text: F.struct(F.lit(role).alias("role"), text.alias("content"))
    return F.array(turn("user", user), turn("assistant", assistant)).cast(MESSAGES)


def function_examples(functions: DataFrame, contexts: Column, key: list[str], seed: int = 42) -> DataFrame:
    """messages, metadata of extracted functions; form and context depend on seed and key."""
    keys = [F.col(k) for k in key]
    given = F.coalesce(
        F.when(F.size(contexts) > 0, F.get(contexts, _pick(seed + 1, 1 << 20, *keys) % F.size(contexts))), F.lit("")
    )
    pairs = functions.withColumn("__context", given)
    prompt = function_prompt(
        F.col("name"), F.col("return_type"), F.col("params"), F.col("__context"), _pick(seed, 4, *keys)
    )
    metadata = F.struct(
        F.col("name").alias("function_name"),
        F.col("__context").alias("context"),
        F.lit(EXAMPLE_SOURCE).alias("source"),
        F.lit(None).cast("string").alias("type"),
        F.col("domain"),
    )
    return pairs.select(_messages(prompt, F.col("body")).alias("messages"), metadata.alias("metadata"))


def completion_parts(code: Column, ratio: float = 0.5) -> Column:
    """struct(split_at, prefix, suffix) of the stripped text's lines; null for under 3 on a side."""
    lines = F.split(strip(code), "\n")
    n = F.size(lines)
    at = F.floor(n * F.lit(ratio)).cast("int")
    parts = F.struct(
        at.alias("split_at"),
        F.array_join(F.slice(lines, F.lit(1), at), "\n").alias("prefix"),
        F.array_join(F.slice(lines, at + 1, n), "\n").alias("suffix"),
    )
    return F.when((at >= 3) & (n - at >= 3), parts)


def completion_examples(files: DataFrame, code: str = "code", ratio: float = 0.5) -> DataFrame:
    """messages, metadata: the first lines of a file of over 200 characters, then the rest."""
    long_enough = files.filter(F.length(code) > MIN_COMPLETION).withColumn("__p", completion_parts(F.col(code), ratio))
    fence = lambda text: F.concat(F.lit("```c\n"), text, F.lit("\n```"))
    ask = F.concat(
        F.lit("Complete the following automotive code:\n\n"), fence(F.col("__p.prefix")), F.lit("\n\nProvide the continuation:")
    )
    none = F.lit(None).cast("string")
    metadata = F.struct(
        none.alias("function_name"), none.alias("context"), F.lit(EXAMPLE_SOURCE).alias("source"), F.lit("code_completion").alias("type"), F.col("domain")
    )
    return long_enough.filter("__p is not null").select(
        _messages(ask, fence(F.col("__p.suffix"))).alias("messages"), metadata.alias("metadata")
    )


def training_examples(files: DataFrame, seed: int = 42) -> DataFrame:
    """Both kinds of examples from path, domain, contexts, code; unread and empty files give none."""
    read = files.filter("code is not null and code <> ''")
    functions = extract_functions(read)
    made = function_examples(functions, F.col("contexts"), ["path", "name", "ordinal"], seed)
    return made.unionByName(completion_examples(read))
