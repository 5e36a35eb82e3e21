"""Sharding by a minimax contiguous partition (operator 7), in DataFrame expressions.

Rows with equal texts form an atomic group.  Groups stand in the order of their
text's MD5.  The smallest capacity for which the greedy cut needs no more than the
given number of shards is found by binary search, and the cuts are made there: the
law is ``bytes``, shard sizes as near equal as whole groups in this order allow.

The search runs on the driver over totals of ranges of the order, named by their
first hexadecimal digits.  For a capacity, cuts at ends of ranges only, and cuts
anywhere within them, enclose each greedy cut from below and above, which shows
some capacities to do and some not to do.  Ranges in which a cut may lie for a
capacity between these are totalled again by two more digits, until the two meet;
a range that holds one group leaves nothing open.  A round brings a bounded number
of totals, whatever the table's size, and no more rounds come than digits.

Slots count the rows of a shard from 0.  Rows are numbered when they are first
written, and dealt into lanes of some ``LANE_ROWS`` rows by a hash of the number;
rank within a lane and lane totals make the slot.  So neither a large group nor
any repeated doc_id gathers in one task.

Null text: size 8, one group with the empty text; a null doc_id is like any other.
Rows that agree in all are each given a slot.  Shards depend on the texts only,
slots also on the order in which rows are read.  An empty table gives an empty
result.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut

SHARDS = 24
#: Digits of the first totals (65,536 ranges at most), and how many each round adds.
FIRST_DIGITS, MORE_DIGITS = 4, 2
KEY_DIGITS = 32
#: Rows that a lane holds on average.
LANE_ROWS = 1000
OVERHEAD = 8


@dataclass
class Ranges:
    """Totals of ranges in order: their digits, bytes, number of groups and largest group."""

    digits: list[str]
    bytes: np.ndarray
    groups: np.ndarray
    largest: int

    def __post_init__(self):
        self.ends = np.cumsum(self.bytes)
        self.total = int(self.ends[-1])

    def least_cuts(self, capacity: int, shards: int) -> list[int]:
        """Greedy cuts at ends of ranges only: each at or before the true one."""
        cuts, at = [], 0
        for _ in range(shards):
            i = int(np.searchsorted(self.ends, at + capacity, side="right"))
            at = int(self.ends[i - 1]) if i else 0
            cuts.append(at)
        return cuts

    def most_cuts(self, capacity: int, shards: int) -> list[int]:
        """Greedy cuts anywhere but within a group that has a range of its own."""
        cuts, at = [], 0
        for _ in range(shards):
            limit = at + capacity
            i = int(np.searchsorted(self.ends, limit, side="right"))
            if i == len(self.ends):
                at = self.total
            else:
                at = (int(self.ends[i - 1]) if i else 0) if self.groups[i] == 1 else limit
            cuts.append(at)
        return cuts

    def open_ranges(self, low: int, high: int, shards: int) -> list[int]:
        """Ranges of several groups that a cut for a capacity from ``low`` to ``high`` may divide."""
        found: set[int] = set()
        for least, most in zip(self.least_cuts(low, shards), self.most_cuts(high, shards), strict=True):
            a, b = (int(np.searchsorted(self.ends, x, side="right")) for x in (least, most))
            found.update(i for i in range(a, min(b, len(self.ends) - 1) + 1) if self.groups[i] > 1)
        return sorted(found)

    def replaced(self, old: list[int], new: list[tuple[str, int, int]]) -> Ranges:
        gone = set(old)
        kept = [(d, int(b), int(g)) for i, (d, b, g) in enumerate(zip(self.digits, self.bytes, self.groups, strict=True)) if i not in gone]
        return ranges_of(kept + new, self.largest)


def ranges_of(rows: list[tuple[str, int, int]], largest: int) -> Ranges:
    rows = sorted(rows)
    return Ranges([r[0] for r in rows], np.array([r[1] for r in rows], dtype=np.int64), np.array([r[2] for r in rows], dtype=np.int64), largest)


def _first(low: int, high: int, holds) -> int:  # noqa: ANN001
    """The smallest number from ``low`` on for which ``holds``, which it does for ``high``."""
    while low < high:
        middle = (low + high) // 2
        low, high = (low, middle) if holds(middle) else (middle + 1, high)
    return high


def _totals(groups: DataFrame, digits: int, within: list[str] | None = None) -> list[tuple[str, int, int, int]]:
    """digits, bytes, groups, largest of all ranges, or of those inside the ranges ``within``."""
    if within is not None:
        groups = groups.filter(F.substring("gkey", 1, len(within[0])).isin(within))
    found = groups.groupBy(F.substring("gkey", 1, digits).alias("digits")).agg(F.sum("bytes"), F.count(F.lit(1)), F.max("bytes"))
    return [tuple(r) for r in found.collect()]


def minimax_cuts(groups: DataFrame, shards: int) -> tuple[int, list[str]]:
    """The smallest feasible capacity, and the digits of the last range before each cut."""
    first = _totals(groups, FIRST_DIGITS)
    if not first:
        return 0, []
    ranges = ranges_of([r[:3] for r in first], max(r[3] for r in first))
    low, high = max(ranges.largest, -(-ranges.total // shards)), ranges.total
    digits = FIRST_DIGITS
    while True:
        total = ranges.total
        high = _first(low, high, lambda c, r=ranges: r.least_cuts(c, shards)[-1] >= total)
        low = _first(low, high, lambda c, r=ranges: r.most_cuts(c, shards)[-1] >= total)
        if low == high:
            ends = dict.fromkeys(x for x in ranges.least_cuts(high, shards) if x < total)
            return high, [ranges.digits[int(np.searchsorted(ranges.ends, x))] for x in ends]
        # All are of the last round's length: a cut never leaves the ranges it was found in.
        again = ranges.open_ranges(low, high, shards)
        digits = min(digits + MORE_DIGITS, KEY_DIGITS)
        found = _totals(groups, digits, [ranges.digits[i] for i in again])
        ranges = ranges.replaced(again, [r[:3] for r in found])


def shard(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard: a row per row of ``docs``."""
    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    rows = cut(
        docs.select(
            docs["doc_id"].alias("doc_id"),
            (F.octet_length(text) + F.lit(OVERHEAD)).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.md5(text.cast("binary")).alias("gkey"),
            F.monotonically_increasing_id().alias("number"),
        ),
        "rows",
    )
    groups = cut(rows.groupBy("gkey").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n")), "groups")
    _, cuts = minimax_cuts(groups, shards)
    # "g" comes after every digit, so a key is greater only if it lies beyond the range.
    number = reduce(lambda a, c: a + (F.col("gkey") > F.lit(c + "g")).cast("int"), cuts, F.lit(0))
    counted = groups.groupBy(number.alias("shard")).agg(F.sum("n").alias("n")).collect()
    lanes = [1] * shards
    for r in counted:
        lanes[r["shard"]] = -(-r["n"] // LANE_ROWS)
    lane = F.pmod(F.xxhash64("number"), F.get(F.lit(lanes), F.col("shard")).cast("long")).alias("lane")
    dealt = rows.withColumn("shard", number).select("doc_id", "size", "text_crc32", "gkey", "number", "shard", lane)
    own = Window.partitionBy("shard", "lane").orderBy("gkey", "doc_id", "number")
    ranked = dealt.withColumn("rank", F.row_number().over(own))
    before = Window.partitionBy("shard").orderBy("lane").rowsBetween(Window.unboundedPreceding, -1)
    sizes = dealt.groupBy("shard", "lane").agg(F.count(F.lit(1)).alias("n"))
    heads = sizes.select("shard", "lane", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("lane_slot"))
    return ranked.join(heads, ["shard", "lane"]).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        F.col("shard").cast("int").alias("shard"),
        (F.col("lane_slot") + F.col("rank") - 1).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
