"""Queries of code scoring."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scoring as q
from ..functions import text as tf
from .tables import CODE_ROWS, code_rows, table


def _rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Code and prompts: web pages with their urls, and code made from parts."""
    pages = table(spark, sf_dir, "pages").selectExpr("concat('page', page_id) AS id", "html AS code", "url AS prompt")
    parts = code_rows(spark, sf_dir).selectExpr("concat('part', id) AS id", "code", "prompt")
    return pages.unionByName(parts)


ROWS = f"""rows AS (SELECT 'page' || page_id AS id, html AS code, url AS prompt FROM pages
  UNION ALL SELECT 'part' || id AS id, code, prompt FROM ({CODE_ROWS}) AS p)"""


def _has(text: str, words: list[str]) -> str:
    return "(" + " OR ".join(f"contains({text}, '{w}')" for w in words) + ")"


def _count(text: str, words: list[str]) -> str:
    return "(" + " + ".join(f"CAST(contains({text}, '{w}') AS INT)" for w in words) + ")"


def _times(part: str) -> str:
    return f"((length(code) - length(replace(code, '{part}', ''))) // {len(part)})"


SYNTAX = r"""CASE WHEN regexp_full_match(code, '\s*') THEN 0.0 ELSE least(10.0, greatest(0.0, 7.0
  - CASE WHEN %s <> %s THEN 2.0 ELSE 0.0 END - CASE WHEN %s <> %s THEN 2.0 ELSE 0.0 END
  - 0.3 * len(list_filter(list_transform(string_split(code, chr(10)), lambda l: regexp_replace(l, '^\s+|\s+$', '', 'g')),
      lambda l: l <> '' AND NOT regexp_matches(l, '(\{|\}|//|/\*|\*/|,|;)$') AND NOT regexp_matches(l, '^(#|if|else|for|while|switch)'))))) END""" % (
    _times("{"), _times("}"), _times("("), _times(")"),
)
PROTOCOL = f"""greatest(0.0, 10.0
  - CASE WHEN {_has("lower(prompt)", q.TSN_ASKED)} THEN 1.5 * greatest(0, 3 - {_count("lower(code)", q.TSN_KEYWORDS)}) ELSE 0.0 END
  - CASE WHEN {_has("lower(prompt)", q.AVB_ASKED)} THEN 1.5 * greatest(0, 3 - {_count("lower(code)", q.AVB_KEYWORDS)}) ELSE 0.0 END
  - CASE WHEN {_has("lower(prompt)", ["eth"])} AND NOT {_has("lower(code)", ["eth_hdr", "ethhdr", "ethernet_header"])} THEN 1.0 ELSE 0.0 END
  - CASE WHEN {_has("lower(prompt)", ["vlan"])} AND NOT {_has("lower(code)", ["vlan_id", "vid"])} THEN 1.5 ELSE 0.0 END)"""
_PENALTY = " + ".join(f"CASE WHEN contains(code, '{p}') THEN {x} ELSE 0.0 END" for p, x in q.VIOLATIONS)
_BONUS = " + ".join(f"CASE WHEN contains(code, '{p}') THEN {x} ELSE 0.0 END" for p, x in q.PRACTICES)
SAFETY = rf"""greatest(0.0, least(10.0, 10.0 - ({_PENALTY}) + least(2.0, {_BONUS}))
  - 1.5 * len(list_filter(regexp_extract_all(code, '(\w+)\s*\([^)]*\)\s*\{{', 1),
      lambda f: (length(code) - length(replace(code, f || '(', ''))) // (length(f) + 1) >= 2))
  - CASE WHEN (contains(replace(code, ' ', ''), 'while(1)') OR contains(code, 'while (1)')) AND NOT contains(code, 'break') THEN 2.0 ELSE 0.0 END)"""
_COMMENTS = f"({_times('//')} + {_times('/*')})"
STYLE = rf"""least(10.0, greatest(0.0, 6.0
  + CASE WHEN {_COMMENTS} >= 5 THEN 2.0 WHEN {_COMMENTS} >= 2 THEN 1.0 WHEN {_COMMENTS} = 0 THEN -1.0 ELSE 0.0 END
  + CASE WHEN contains(code, '/**') THEN 1.0 ELSE 0.0 END
  + CASE WHEN contains(code, '@param') OR contains(code, '@return') THEN 0.5 ELSE 0.0 END
  + CASE WHEN contains(code, '@brief') THEN 0.5 ELSE 0.0 END
  - CASE WHEN len(regexp_extract_all(translate(code, 'äöüßéèêàâçñíóúáÄÖÜÉÈÊÀÂÇÑÍÓÚÁ', 'AAAAAAAAAAAAAAAAAAAAAAAAAAAAA'), '\b[a-z]\s*[=;]')) > 5 THEN 1.0 ELSE 0.0 END
  - CASE WHEN len(list_filter(string_split(code, chr(10)), lambda l: starts_with(l, chr(9)))) > 0
      AND len(list_filter(string_split(code, chr(10)), lambda l: regexp_matches(l, '^\s') AND NOT starts_with(l, chr(9)))) > 0 THEN 0.5 ELSE 0.0 END))"""
OVERALL = f"0.30 * ({SYNTAX}) + 0.30 * ({PROTOCOL}) + 0.25 * ({SAFETY}) + 0.15 * ({STYLE})"


def _score(column: str):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        code, prompt = F.col("code"), F.col("prompt")
        value = {
            "syntax": lambda: q.syntax_score(code),
            "protocol": lambda: q.protocol_score(code, prompt),
            "safety": lambda: q.safety_score(code),
            "style": lambda: q.style_score(code),
        }[column]()
        return _rows(spark, sf_dir).select("id", F.round(value, 6).alias(column))

    return query


def q8_overall(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _rows(spark, sf_dir).select("id", q.quality(F.col("code"), F.col("prompt")).alias("q"))
    return rows.select("id", *[F.round(f"q.{c}", 6).alias(c) for c in ("syntax", "protocol", "safety", "style", "overall")])


def q10_needs_correction(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _rows(spark, sf_dir).select("id", F.round(q.quality(F.col("code"), F.col("prompt"))["overall"], 6).alias("overall"))
    return rows.filter(q.needs_correction(F.col("overall")))


_FENCED = """concat('Some text. ', chr(96), chr(96), chr(96), CASE p_size % 3 WHEN 0 THEN 'c' WHEN 1 THEN 'cpp' ELSE 'python' END, chr(10),
  p_name, ';', chr(10), chr(96), chr(96), chr(96), ' and ~~~c', chr(10), p_brand, chr(10), '~~~ end')"""


def q1_code_block(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "part").selectExpr("p_partkey AS id", f"{_FENCED} AS text")
    return rows.select("id", tf.code_block(F.col("text")).alias("code"))


Q1 = f"""WITH t AS (SELECT p_partkey AS id, p_size, p_name, p_brand, {_FENCED} AS text FROM part)
SELECT id, CASE p_size % 3 WHEN 2 THEN p_brand || chr(10) ELSE p_name || ';' || chr(10) END AS code FROM t"""


def q2_wrap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return code_rows(spark, sf_dir).select("id", F.md5(tf.wrap_for_compiler(F.col("code"))).alias("digest"))


Q2 = f"""SELECT id, md5(CASE WHEN contains(substr(code, 1, 500), '#include') THEN code
  ELSE '{tf.COMPILER_HEADERS}' || code END) AS digest FROM ({CODE_ROWS}) AS t"""

QUERIES = {
    "q1_code_block": q1_code_block,
    "q2_wrap": q2_wrap,
    "q3_syntax": _score("syntax"),
    "q5_protocol": _score("protocol"),
    "q6_safety": _score("safety"),
    "q7_style": _score("style"),
    "q8_overall": q8_overall,
    "q10_needs_correction": q10_needs_correction,
}
_ALL = {"syntax": SYNTAX, "protocol": PROTOCOL, "safety": SAFETY, "style": STYLE, "overall": OVERALL}
ORACLES = {
    "q1_code_block": Q1,
    "q2_wrap": Q2,
    **{
        name: f"WITH {ROWS} SELECT id, round(CAST({_ALL[c]} AS DOUBLE), 6) AS {c} FROM rows"
        for name, c in (("q3_syntax", "syntax"), ("q5_protocol", "protocol"), ("q6_safety", "safety"), ("q7_style", "style"))
    },
    "q8_overall": f"WITH {ROWS} SELECT id, "
    + ", ".join(f"round(CAST({sql} AS DOUBLE), 6) AS {c}" for c, sql in _ALL.items())
    + " FROM rows",
    "q10_needs_correction": f"WITH {ROWS} SELECT id, overall FROM (SELECT id, round(CAST({OVERALL} AS DOUBLE), 6) AS overall FROM rows) AS t WHERE overall < 7.0",
}
