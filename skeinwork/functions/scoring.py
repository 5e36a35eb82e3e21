"""Rule-based scores of C code: syntax, protocol, safety, style and their sum.

Every rule is a column expression, so a score costs one pass in generated code.
The rules follow the scored system to the letter, odd cases included: a short
integer type's name also counts where a longer one holds it, and any later call
of a function counts as recursion.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import strip

#: Protocol words looked for in code.
TSN_KEYWORDS = ["pcp", "vlan", "timestamp", "gate", "priority", "qbv", "qav", "shaper", "gcl", "schedule"]
AVB_KEYWORDS = ["stream", "sample", "channel", "bandwidth", "srp", "talker", "listener", "reservation", "class"]
#: Words of a prompt that ask for a protocol.
TSN_ASKED = ["tsn", "802.1q", "qbv", "qav", "802.1as", "time-aware", "shaper"]
AVB_ASKED = ["avb", "audio", "video", "stream reservation", "srp", "listener", "talker"]
#: Penalties and bonuses for text found in code.
VIOLATIONS = [
    ("goto ", 3.0), ("malloc(", 2.0), ("free(", 2.0), ("realloc(", 2.0), ("calloc(", 2.0),
    ("setjmp", 3.0), ("longjmp", 3.0), ("abort(", 1.5), ("exit(", 1.5),
]
PRACTICES = [
    ("uint8_t", 0.5), ("uint16_t", 0.5), ("uint32_t", 0.5), ("uint64_t", 0.5), ("int8_t", 0.5),
    ("int16_t", 0.5), ("int32_t", 0.5), ("static ", 0.3), ("const ", 0.3), ("volatile ", 0.2),
]
#: Weights of the four scores.
WEIGHTS = {"syntax": 0.30, "protocol": 0.30, "safety": 0.25, "style": 0.15}
CORRECTION_THRESHOLD = 7.0


def occurrences(text: Column, part: str) -> Column:
    return ((F.length(text) - F.length(F.replace(text, F.lit(part)))) / len(part)).cast("int")


def _any(text: Column, words: list[str]) -> Column:
    out = F.contains(text, F.lit(words[0]))
    for w in words[1:]:
        out = out | F.contains(text, F.lit(w))
    return out


def _number(text: Column, words: list[str]) -> Column:
    return sum((F.contains(text, F.lit(w)).cast("int") for w in words), F.lit(0))


def _cost(condition: Column, amount: float) -> Column:
    return F.when(condition, F.lit(amount)).otherwise(F.lit(0.0))


def syntax_score(code: Column) -> Column:
    """Balance of brackets and ends of statements; blank code scores 0, 7 is the most."""
    lines = F.transform(F.split(code, "\n"), strip)
    ended = r"(\{|\}|//|/\*|\*/|,|;)$"
    opened = r"^(#|if|else|for|while|switch)"
    loose = F.filter(lines, lambda x: (x != "") & ~x.rlike(ended) & ~x.rlike(opened))
    start = (
        F.lit(7.0)
        - _cost(occurrences(code, "{") != occurrences(code, "}"), 2.0)
        - _cost(occurrences(code, "(") != occurrences(code, ")"), 2.0)
    )
    # Subtracted one at a time, for the same rounding as the scored system's.
    score = F.aggregate(F.array_repeat(F.lit(0), F.size(loose)), start, lambda a, _: a - 0.3)
    return F.when(strip(code) == "", 0.0).otherwise(F.least(F.greatest(score, F.lit(0.0)), F.lit(10.0)))


def protocol_score(code: Column, prompt: Column) -> Column:
    """Protocol words that the prompt asks for; 10 if it asks for none."""
    low, asked = F.lower(code), F.lower(prompt)

    def missing(words: list[str]) -> Column:
        return F.greatest(F.lit(3) - _number(low, words), F.lit(0)) * 1.5

    score = (
        F.lit(10.0)
        - F.when(_any(asked, TSN_ASKED), missing(TSN_KEYWORDS)).otherwise(0.0)
        - F.when(_any(asked, AVB_ASKED), missing(AVB_KEYWORDS)).otherwise(0.0)
        - _cost(_any(asked, ["ethernet", "eth"]) & ~_any(low, ["eth_hdr", "ethhdr", "ethernet_header"]), 1.0)
        - _cost(F.contains(asked, F.lit("vlan")) & ~_any(low, ["vlan_id", "vid"]), 1.5)
    )
    return F.greatest(score, F.lit(0.0))


def safety_score(code: Column) -> Column:
    """Forbidden calls, good practices, recursion and endless loops."""
    penalty = sum((_cost(F.contains(code, F.lit(p)), x) for p, x in VIOLATIONS), F.lit(0.0))
    bonus = sum((_cost(F.contains(code, F.lit(p)), x) for p, x in PRACTICES), F.lit(0.0))
    base = F.least(F.lit(10.0) - penalty + F.least(bonus, F.lit(2.0)), F.lit(10.0))

    def again(score: Column, name: Column) -> Column:
        call = F.concat(name, F.lit("("))
        first = F.call_function("locate", call, code)
        later = F.call_function("locate", call, code, first + F.length(call))
        return F.when((first > 0) & (later > 0), score - 1.5).otherwise(score)

    heads = F.regexp_extract_all(code, F.lit(r"(?U)(\w+)\s*\([^)]*\)\s*\{"), F.lit(1))
    score = F.aggregate(heads, base, again)
    endless = F.contains(F.replace(code, F.lit(" ")), F.lit("while(1)")) | F.contains(code, F.lit("while (1)"))
    return F.greatest(score - _cost(endless & ~F.contains(code, F.lit("break")), 2.0), F.lit(0.0))


def style_score(code: Column) -> Column:
    """Comments, documentation tags, single-letter names and mixed indentation."""
    comments = occurrences(code, "//") + occurrences(code, "/*")
    lines = F.split(code, "\n")
    by_tab = F.exists(lines, lambda x: (x != "") & x.startswith("\t"))
    by_blank = F.exists(lines, lambda x: x.rlike(r"(?U)^\s") & ~x.startswith("\t"))
    score = (
        F.lit(6.0)
        + F.when(comments >= 5, 2.0).when(comments >= 2, 1.0).when(comments == 0, -1.0).otherwise(0.0)
        + _cost(F.contains(code, F.lit("/**")), 1.0)
        + _cost(_any(code, ["@param", "@return"]), 0.5)
        + _cost(F.contains(code, F.lit("@brief")), 0.5)
        - _cost(F.regexp_count(code, F.lit(r"(?U)\b[a-z]\s*[=;]")) > 5, 1.0)
        - _cost(by_tab & by_blank, 0.5)
    )
    return F.least(F.greatest(score, F.lit(0.0)), F.lit(10.0))


def overall_score(syntax: Column, protocol: Column, safety: Column, style: Column) -> Column:
    parts = {"syntax": syntax, "protocol": protocol, "safety": safety, "style": style}
    terms = [parts[k] * w for k, w in WEIGHTS.items()]
    return terms[0] + terms[1] + terms[2] + terms[3]


def quality(code: Column, prompt: Column, syntax: Column | None = None) -> Column:
    """struct<syntax, protocol, safety, style, overall> of extracted code.

    ``syntax`` is a compiler's score where there is one, else the rules' own.
    """
    syntax, protocol = syntax_score(code) if syntax is None else syntax, protocol_score(code, prompt)
    safety, style = safety_score(code), style_score(code)
    return F.struct(
        syntax.alias("syntax"),
        protocol.alias("protocol"),
        safety.alias("safety"),
        style.alias("style"),
        overall_score(syntax, protocol, safety, style).alias("overall"),
    )


def needs_correction(overall: Column, threshold: float = CORRECTION_THRESHOLD) -> Column:
    return overall < threshold
