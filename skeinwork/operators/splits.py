"""Exact dedup, exact seeded splits and leakage between sets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .places import in_ranges

BUCKET_DIGITS = 3


def deduplicate(rows: DataFrame, on: list[str], order: list[str]) -> DataFrame:
    """The first row, by ``order``, for each value of ``on``.

    A least-struct aggregate with a map-side part; equal rows never meet in a window.
    """
    rest = [c for c in rows.columns if c not in on]
    first = F.min(F.struct(*[F.col(c) for c in order], *[F.col(c).alias(f"__{i}") for i, c in enumerate(rest)]))
    kept = rows.groupBy(*on).agg(first.alias("__first"))
    return kept.select(*[F.col(f"__first.__{rest.index(c)}").alias(c) if c in rest else F.col(c) for c in rows.columns])


def digest(messages: Column) -> Column:
    return F.md5(F.to_json(messages))


def shuffle_key(seed: int, key: Column) -> Column:
    """Order by this is a shuffle that depends on seed and key only."""
    return F.md5(F.concat(F.lit(f"{seed}|"), key.cast("string")))


def shuffled(rows: DataFrame, key: Column, seed: int = 42) -> DataFrame:
    """``rows`` in an order that depends on seed and key only; a write keeps it over its files.

    Sorted by ranges of the seeded hash, so no task sorts the whole table.
    """
    return in_ranges(rows.withColumn("__h", shuffle_key(seed, key)), ["__h"]).drop("__h")


def exact_split(rows: DataFrame, key: str, ratio: float = 0.9, seed: int = 42) -> DataFrame:
    """``rows`` with ``split``: exactly floor(n * ratio) rows are ``train``, the others ``val``.

    Rows are ranked by a seeded hash without a sort of the whole table: counts of 4096
    ranges of the hash tell which ranges lie on either side of the cut, and ranks
    within a range do the rest.
    """
    hashed = rows.withColumn("__h", shuffle_key(seed, F.col(key))).withColumn("__b", F.substring("__h", 1, BUCKET_DIGITS))
    counts = hashed.groupBy("__b").agg(F.count(F.lit(1)).alias("__n"))
    # At most 16 to the power of BUCKET_DIGITS rows.
    running = Window.orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    offsets = counts.select(
        F.col("__b"),
        F.coalesce(F.sum("__n").over(running), F.lit(0)).alias("__before"),
        F.floor(F.sum("__n").over(every) * F.lit(ratio)).alias("__cut"),
    )
    rank = F.row_number().over(Window.partitionBy("__b").orderBy("__h", F.col(key)))
    placed = hashed.withColumn("__r", rank).join(F.broadcast(offsets), "__b")
    split = F.when(F.col("__before") + F.col("__r") <= F.col("__cut"), "train").otherwise("val")
    return placed.withColumn("split", split).select(*rows.columns, "split")


def shared_rows(left: DataFrame, right: DataFrame, on: Column | str) -> DataFrame:
    """Rows of ``left`` whose key also occurs in ``right`` (leakage)."""
    key = F.col(on) if isinstance(on, str) else on
    others = right.select(key.alias("__key")).distinct()
    return left.withColumn("__key", key).join(others, "__key", "left_semi").drop("__key")


def prompt_in_response(rows: DataFrame, prompt: str = "prompt", response: str = "response") -> DataFrame:
    return rows.filter(F.contains(F.col(response), F.col(prompt)))
