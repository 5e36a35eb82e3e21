"""Scores against a plain restatement of the rules, and the known cases."""

import random
import re

import pytest
from pyspark.sql import functions as F

from skeinwork.functions import scoring


def syntax(code):
    if not code.strip():
        return 0.0
    s = 7.0 - 2.0 * (code.count("{") != code.count("}")) - 2.0 * (code.count("(") != code.count(")"))
    for line in map(str.strip, code.split("\n")):
        if line and not line.endswith(("{", "}", "//", "/*", "*/", ",", ";")) and not line.startswith(("#", "if", "else", "for", "while", "switch")):
            s -= 0.3
    return min(10.0, max(0.0, s))


def protocol(code, prompt):
    c, p, s = code.lower(), prompt.lower(), 10.0
    for asked, words in ((scoring.TSN_ASKED, scoring.TSN_KEYWORDS), (scoring.AVB_ASKED, scoring.AVB_KEYWORDS)):
        if any(a in p for a in asked):
            s -= 1.5 * max(0, 3 - sum(w in c for w in words))
    s -= 1.0 * ("eth" in p and not any(w in c for w in ("eth_hdr", "ethhdr", "ethernet_header")))
    s -= 1.5 * ("vlan" in p and "vlan_id" not in c and "vid" not in c)
    return max(0.0, s)


def safety(code):
    s = 10.0 - sum(x for p, x in scoring.VIOLATIONS if p in code)
    s = min(10.0, s + min(2.0, sum(x for p, x in scoring.PRACTICES if p in code)))
    for name in re.findall(r"(\w+)\s*\([^)]*\)\s*\{", code):
        s -= 1.5 * (code.count(name + "(") >= 2)
    endless = "while(1)" in code.replace(" ", "") or "while (1)" in code
    return max(0.0, s - 2.0 * (endless and "break" not in code))


def style(code):
    n = code.count("//") + code.count("/*")
    s = 6.0 + (2.0 if n >= 5 else 1.0 if n >= 2 else -1.0 if n == 0 else 0.0)
    s += 1.0 * ("/**" in code) + 0.5 * ("@param" in code or "@return" in code) + 0.5 * ("@brief" in code)
    s -= 1.0 * (len(re.findall(r"\b[a-z]\s*[=;]", code)) > 5)
    lines = code.split("\n")
    tab = any(x.startswith("\t") and x for x in lines)
    blank = any(x and x[0].isspace() and x[0] != "\t" for x in lines)
    return min(10.0, max(0.0, s - 0.5 * (tab and blank)))


PIECES = [
    "if(a){", "}", "f(", ")", "f(x) {", "while (1)", "while( 1 )", "break", "goto out;", "malloc(4)", "free(p)", "uint8_t", "int16_t", "static ",
    "const ", "//", "/*", "/**", "*/", "@param", "@brief", "x = 1;", "a;", "\t", "    ", "\n", "\n", " ", "eth_hdr", "vlan_id", "gate", "pcp", "stream", "é",
    "#include", "talker", "recurse(n) {", "recurse(n);", ",",
]
PROMPTS = ["sort a list", "a TSN shaper", "AVB audio with VLAN", "a method", "Ethernet frames", ""]


def test_random_texts(spark):
    rng = random.Random(12)
    rows = [("".join(rng.choice(PIECES) for _ in range(rng.randrange(40))), rng.choice(PROMPTS)) for _ in range(1200)]
    q = scoring.quality(F.col("code"), F.col("prompt"))
    got = spark.createDataFrame(rows, "code string, prompt string").select("code", "prompt", q.alias("q")).collect()
    for r in got:
        want = (syntax(r.code), protocol(r.code, r.prompt), safety(r.code), style(r.code))
        assert (r.q.syntax, r.q.protocol, r.q.safety, r.q.style) == pytest.approx(want, abs=1e-9), r.code


CASES = [
    ("int x = 1;", "anything at all", "protocol", "==", 10.0),
    ("void f(void) { goto out; }", "", "safety", "<=", 7.0),
    ("p = malloc(4); free(p);", "", "safety", "<=", 6.0),
    ("int f(int n) { return f(n - 1); }", "", "safety", "<=", 8.5),
    ("while(1) { a(); }", "", "safety", "<=", 8.0),
    ("int a;", "", "style", "<=", 6.0),
    ("// a\n// b\n// c\n// d\n// e\n", "", "style", ">=", 8.0),
    ("  \n ", "", "syntax", "==", 0.0),
]


def test_known_cases(spark):
    frame = spark.createDataFrame([(i, c, p) for i, (c, p, *_) in enumerate(CASES)], "i int, code string, prompt string")
    for r in frame.select("i", scoring.quality(F.col("code"), F.col("prompt")).alias("q")).collect():
        _, _, part, how, limit = CASES[r.i]
        value = r.q[part]
        assert {"==": value == limit, "<=": value <= limit, ">=": value >= limit}[how], CASES[r.i]


def test_overall(spark):
    rows = [(10.0, 10.0, 10.0, 10.0, 10.0), (0.0, 10.0, 10.0, 10.0, 7.0), (8.0, 6.0, 9.0, 7.0, 7.5)]
    frame = spark.createDataFrame(rows, "a double, b double, c double, d double, want double")
    got = frame.select(scoring.overall_score(*[F.col(c) for c in "abcd"]).alias("got"), "want").collect()
    assert all(r.got == pytest.approx(r.want) for r in got)
    low = spark.createDataFrame([(6.9,), (7.0,)], "s double").filter(scoring.needs_correction(F.col("s"))).collect()
    assert [r.s for r in low] == [6.9]
