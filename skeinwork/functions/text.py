"""Text functions over columns, all inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fenced blocks, tried in this order.
FENCE = r"(?s)```(?:c|cpp|C|C\+\+)?\n(.*?)```"
TILDE = r"(?s)~~~(?:c|cpp)?\n(.*?)~~~"
#: Code entities in a text.
FILE_PATH = r"""(?:^|[\s'"`(])([a-zA-Z0-9_./\\-]+\.(?:py|c|h|cpp|hpp|yaml|yml|json|toml|cfg|sh|md))\b"""
FUNCTION_NAME = r"\bdef\s+(\w+)\s*\("
CLASS_NAME = r"\bclass\s+(\w+)[\s(:]"
#: Metrics in a training log.
LOG_METRICS = {
    "train_loss": r"Train loss: ([0-9\.]+)",
    "avg_student_score": r"Avg student score: ([0-9\.]+)",
    "correction_rate": r"Correction rate: ([0-9\.]+)%",
    "num_corrections": r"Corrections: ([0-9]+)",
}
#: Fixed value: what code without includes is given before it is compiled.
COMPILER_HEADERS = """
#include <stdint.h>
#include <stdbool.h>
#include <stddef.h>
#include <string.h>

// Placeholder for automotive types
#ifndef ETH_ALEN
#define ETH_ALEN 6
#endif

"""
CHAT_ROLES = ("user", "assistant", "system")


def strip(text: Column) -> Column:
    """Without white space (Unicode's) at either end."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def decode_code(content: Column) -> Column:
    """Bytes as UTF-8, or all of them as Latin-1 if any is invalid; newlines become \\n."""
    as_text = content.cast("string")
    text = F.when(F.is_valid_utf8(as_text), as_text).otherwise(F.decode(content, "ISO-8859-1"))
    return F.regexp_replace(text, "\r\n?", "\n")


def token_count(text: Column) -> Column:
    """Words between white space."""
    return F.size(F.filter(F.split(text, r"(?U)\s+"), lambda w: w != ""))


def first_tokens(text: Column, n: int) -> Column:
    """The first ``n`` tokens of a text parted by single blanks."""
    return F.array_join(F.slice(F.split(text, " "), 1, n), " ")


def code_block(text: Column) -> Column:
    """Bodies of fenced blocks joined by newlines; tilde fences next; else the text."""

    def bodies(pattern: str) -> Column:
        return F.regexp_extract_all(text, F.lit(pattern), F.lit(1))

    fenced, tilded = bodies(FENCE), bodies(TILDE)
    return (
        F.when(F.size(fenced) > 0, F.array_join(fenced, "\n"))
        .when(F.size(tilded) > 0, F.array_join(tilded, "\n"))
        .otherwise(text)
    )


def render_chat(messages: Column) -> Column:
    """``<|role|>`` turns, one after the other; messages with other roles are dropped."""
    known = F.filter(messages, lambda m: m["role"].isin(*CHAT_ROLES))
    turns = F.transform(known, lambda m: F.concat(F.lit("<|"), m["role"], F.lit("|>\n"), m["content"], F.lit("\n")))
    return F.array_join(turns, "")


def wrap_for_compiler(code: Column) -> Column:
    """Standard headers before code that includes none within its first 500 characters."""
    bare = F.instr(F.substring(code, 1, 500), "#include") == 0
    return F.when(bare, F.concat(F.lit(COMPILER_HEADERS), code)).otherwise(code)


def human_size(size: Column) -> Column:
    """struct(number, unit): steps of 1024 from B to PB, the number to one decimal."""
    number = size.cast("double")
    out = F.struct(F.round(number / 1024.0**5, 1).alias("number"), F.lit("PB").alias("unit"))
    for step in range(4, -1, -1):
        unit = ("B", "KB", "MB", "GB", "TB")[step]
        scaled = number / 1024.0**step
        out = F.when(scaled < 1024, F.struct(F.round(scaled, 1).alias("number"), F.lit(unit).alias("unit"))).otherwise(out)
    return out


def format_size(size: Column) -> Column:
    parts = human_size(size)
    return F.concat(F.format_string("%.1f", parts["number"]), F.lit(" "), parts["unit"])


def log_metrics(line: Column) -> Column:
    """struct of the four metrics of a log line; null where a line has none."""

    fields = []
    for name, pattern in LOG_METRICS.items():
        found = F.regexp_extract(line, pattern, 1)
        fields.append(F.when(found != "", found.try_cast("double")).alias(name))
    return F.struct(*fields)


def code_entities(text: Column) -> Column:
    """array<struct<file_path, entity_type, name>>: files, then functions, then classes.

    Each kind keeps first occurrences only.  A file's name is its last path part
    without the last extension; functions and classes have an empty path.
    """

    def hits(pattern: str) -> Column:
        return F.array_distinct(F.regexp_extract_all(text, F.lit("(?U)" + pattern), F.lit(1)))

    def entity(path: Column, kind: str, name: Column) -> Column:
        return F.struct(path.alias("file_path"), F.lit(kind).alias("entity_type"), name.alias("name"))

    files = F.transform(
        hits(FILE_PATH),
        lambda p: entity(p, "file", F.regexp_replace(F.element_at(F.split(p, "/"), -1), r"\.[^.]*$", "")),
    )
    functions = F.transform(hits(FUNCTION_NAME), lambda n: entity(F.lit(""), "function", n))
    classes = F.transform(hits(CLASS_NAME), lambda n: entity(F.lit(""), "class", n))
    return F.concat(files, functions, classes)
