"""Inputs that several queries share, as expressions both engines read alike."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..session import scratch

__all__ = ["CODE", "CODE_ROWS", "PROMPT", "code_rows", "scratch", "table"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: C code made from a row of ``part``.
CODE = """concat(
  CASE WHEN p_size % 3 = 0 THEN concat('/** @brief part ', p_name, ' */', chr(10)) ELSE '' END,
  CASE WHEN p_size % 8 = 0 THEN concat('#include <stdint.h>', chr(10), '// one', chr(10), '// two', chr(10)) ELSE '' END,
  'static int fn_', CAST(p_partkey AS STRING), '(int a, uint8_t vlan_id) {', chr(10),
  CASE WHEN p_size % 2 = 0 THEN concat(chr(9), 'int x = a; // set', chr(10)) ELSE concat('    x = a', chr(10)) END,
  CASE WHEN p_size % 5 = 0 THEN concat('    goto out;', chr(10)) ELSE '' END,
  CASE WHEN p_size % 7 = 0 THEN concat('    char *p = malloc(4); free(p);', chr(10)) ELSE '' END,
  CASE WHEN p_size % 4 = 0 THEN concat('    if (a > 1) { return fn_', CAST(p_partkey AS STRING), '(a, 1); }', chr(10)) ELSE '' END,
  CASE WHEN p_size % 6 = 0 THEN concat('    while (1) { a = a + 1; }', chr(10)) ELSE '' END,
  CASE WHEN p_size % 9 = 0 THEN concat('    a = 1; b = 2; c = 3; d = 4; e = 5; f = 6;', chr(10), '  (unbalanced', chr(10)) ELSE '' END,
  '    schedule_gate(a, priority);', chr(10), '    return a;', chr(10), '}', chr(10))"""

#: A prompt made from the same row.
PROMPT = """concat('Generate C code for ',
  CASE p_size % 4 WHEN 0 THEN 'a TSN shaper with VLAN tags' WHEN 1 THEN 'an AVB audio talker' WHEN 2 THEN 'Ethernet frames' ELSE 'a sort' END,
  ' ', p_name)"""


def code_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id, code, prompt from ``part``."""
    return table(spark, sf_dir, "part").selectExpr("p_partkey AS id", f"{CODE} AS code", f"{PROMPT} AS prompt")


CODE_ROWS = f"SELECT p_partkey AS id, {CODE} AS code, {PROMPT} AS prompt FROM part"
