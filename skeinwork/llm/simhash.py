"""SimHash near-duplicate groups (operator 5).

Fingerprints: the bit majority over the XXH64 of all three-word shingles.  Equal
fingerprints are one class.  The distinct fingerprints are compared exactly, tile
by tile, with numpy's exclusive-or and bit counts.  A tile holds fingerprints
with the same population counts in each of four 16-bit quarters.  Two fingerprints
within the radius differ in these four counts by no more than the radius altogether,
so tiles further apart are skipped.  Neighbouring tiles meet through a join on the
counts; a task keeps a union-find over the links it finds and passes on a spanning
forest, so a dense group gives few edges.  Components are then found by rounds of
joins.

``keep_similar`` looks for documents whose sets of five-word shingles are alike by
0.8 or more (Jaccard).  Fingerprints of so similar texts differ in 10 of 64 bits on
average, so its radius is wide, and a link also asks of three more, independent
fingerprints that all together differ in no more bits than that similarity lets
expect, and of the numbers of shingles that they are alike by 0.8.  Its tiles are of
one range of population counts, as wide as the radius, and of one range of numbers
of shingles, as wide as 0.8 allows; only tiles of the same or neighbouring ranges
meet.

Null text counts as empty: no words, fingerprint zero, linked like any other.  A
null doc_id never names a component unless all its members' are null (then null).
Repeated rows are returned as often as they came.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, record_batch, small_batches, utf8
from .components import connected_components

SHINGLE, SEED, RADIUS = 3, 42, 2
#: Fingerprints that a tile holds on average where a combination of counts has many.
TILE = 2048
#: Pairs of fingerprints that are compared at a time (memory: 9 bytes each).
STRIP = 1 << 20
#: Similar documents: shingles, similarity, bits of the first fingerprint, its tiles.
#: Of 256 bits, texts alike by 0.8 differ in 256 * acos(0.8 * 2 / 1.8) / pi = 38.7.
SIMILAR_SHINGLE, SIMILARITY, SIMILAR_RADIUS, SIMILAR_BITS, SIMILAR_TILE = 5, 0.8, 14, 40, 1 << 16
#: Odd factors that make further hashes of a shingle's first.
FACTORS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)
PRINTS = ["fp", *[f"fp{i + 2}" for i in range(len(FACTORS))]]
#: Links in a task's union-find before its forest is passed on.
FOREST = 500_000


def shingle_hashes(text: bytes, shingle: int, seed: int = SEED) -> np.ndarray:
    words = text.lower().split()
    if not words:
        return np.zeros(0, dtype=np.uint64)
    joined = b" ".join(words)
    if len(words) <= shingle:
        return np.array([xxhash.xxh64_intdigest(joined, seed)], dtype=np.uint64)
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts = ends - sizes
    digest = xxhash.xxh64_intdigest
    places = zip(starts[: len(words) - shingle + 1].tolist(), ends[shingle - 1 :].tolist(), strict=True)
    return np.array([digest(joined[a:b], seed) for a, b in places], dtype=np.uint64)


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """Majority bits of the shingles' hashes; bit i is set if over half of them set it."""
    hashes = shingle_hashes(text, shingle)
    return majority(hashes) if len(hashes) else 0


def similar_prints(text: bytes, shingle: int) -> tuple[int, ...]:
    """The fingerprints PRINTS of the set of shingles, and its size."""
    first = np.unique(shingle_hashes(text, shingle))
    if not len(first):
        return (0,) * (len(PRINTS) + 1)
    made = [majority(first)]
    # Further hashes are made of the first, which tells shingles apart already.
    for factor in FACTORS:
        other = (first ^ (first >> np.uint64(31))) * np.uint64(factor)
        other = (other ^ (other >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        made.append(majority(other ^ (other >> np.uint64(32))))
    return *made, len(first)


def majority(hashes: np.ndarray) -> int:
    counts = np.zeros(64, dtype=np.int64)
    for i in range(0, len(hashes), 8192):
        part = hashes[i : i + 8192].astype("<u8")
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    set_bits = (counts * 2 > len(hashes)).astype(np.uint8)
    return int(np.packbits(set_bits, bitorder="little").view("<u8")[0])


def _text_mark(docs: DataFrame) -> Column:
    """A hash of the text and of all columns but the id, so that rows with one mark and id are equal."""
    others = [docs[f"`{c}`"].alias(f"c{i}") for i, c in enumerate(docs.columns) if c not in ("doc_id", "text")]
    rest = F.to_json(F.struct(*others)) if others else F.lit("")
    return F.xxhash64(F.coalesce(docs["text"].cast("string"), F.lit("")), rest)


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, fp (the fingerprint as a signed long) and mark (of the text), a row per document."""
    small_batches(docs.sparkSession)
    schema = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64()), ("mark", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t.as_py(), shingle) for t in batch.column(1)], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64)), batch.column(2)], schema=schema)

    chosen = docs.select(docs["doc_id"].cast("long").alias("doc_id"), utf8(docs["text"]).alias("raw"), _text_mark(docs).alias("mark"))
    return chosen.mapInArrow(run, "doc_id long, fp long, mark long")


def similar_fingerprints(docs: DataFrame, shingle: int) -> DataFrame:
    """doc_id, mark, PRINTS, size (of the set of shingles), and node, which stands for these."""
    small_batches(docs.sparkSession)
    columns = ["doc_id", "mark", *PRINTS, "size"]
    schema = pa.schema([(c, pa.int64()) for c in columns])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = np.array([similar_prints(t.as_py(), shingle) for t in batch.column(2)], dtype=np.uint64).reshape(-1, len(PRINTS) + 1)
            prints = [pa.array(np.ascontiguousarray(made[:, i]).view(np.int64)) for i in range(len(PRINTS) + 1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *prints], schema=schema)

    chosen = docs.select(docs["doc_id"].cast("long").alias("doc_id"), _text_mark(docs).alias("mark"), utf8(docs["text"]).alias("raw"))
    made = chosen.mapInArrow(run, ", ".join(f"{c} long" for c in columns))
    return made.withColumn("node", F.xxhash64(*PRINTS, "size"))


def _counts(parts: int) -> list:
    """Population counts of so many equal parts of the fingerprint."""
    bits = 64 // parts
    return [F.bit_count(F.shiftrightunsigned("fp", bits * i).bitwiseAND((1 << bits) - 1 if bits < 64 else -1)) for i in range(parts)]


def _ranges(radius: int) -> list:
    """Ranges of the population count and of the size; what is linked is in the same or the next ones."""
    # A little wider than needed, so that rounding never parts neighbours.
    width = math.log(1 / SIMILARITY) * (1 + 1e-9)
    return [F.floor(_counts(1)[0] / F.lit(radius + 1)), F.floor(F.ln(F.greatest("size", F.lit(1)).cast("double")) / F.lit(width))]


def _steps(each: int, together: int, parts: int) -> list[tuple[int, ...]]:
    """Differences by part and altogether, one of each pair of opposites, zero first."""
    near = [d for d in product(range(-each, each + 1), repeat=parts) if sum(map(abs, d)) <= together]
    return sorted((d for d in near if d >= (0,) * parts), key=lambda d: sum(map(abs, d)))


def _shifted(step: tuple[int, ...]) -> int:
    out = 0
    for d in step:
        out = out * 256 + d
    return out


def _code(parts: list) -> F.Column:
    """Numbers (each up to 200, and shifted so that differences don't carry over) as one."""
    out = F.lit(0)
    for p in parts:
        out = out * F.lit(256) + p.cast("int") + F.lit(16)
    return out


class Forest:
    """Union-find over the nodes that a task has linked."""

    def __init__(self):
        self.parent: dict[int, int] = {}

    def find(self, x: int) -> int:
        root = x
        while (up := self.parent.get(root, root)) != root:
            root = up
        while (up := self.parent.get(x, x)) != root:
            self.parent[x] = root
            x = up
        return root

    def link(self, a: int, b: int) -> bool:
        a, b = self.find(a), self.find(b)
        if a == b:
            return False
        self.parent[max(a, b)] = min(a, b)
        self.parent.setdefault(min(a, b), min(a, b))
        return True

    def link_all(self, left: np.ndarray, right: np.ndarray, a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
        """Links nodes left[a[i]] with right[b[i]] (a in order); returns the links that joined two trees.

        One link of each node comes first: in a dense group these join almost all, and
        what is left is seen by the roots.
        """
        rows = np.flatnonzero(np.diff(a, prepend=-1))
        first = np.full(len(right), -1)
        first[b[::-1]] = np.arange(len(b))[::-1]
        columns = np.flatnonzero(first >= 0)
        new = self._link(left[a[rows]], right[b[rows]]) + self._link(left[a[first[columns]]], right[columns])
        left_root, right_root = np.zeros(len(left), dtype=np.int64), np.zeros(len(right), dtype=np.int64)
        left_root[a[rows]] = [self.find(x) for x in left[a[rows]].tolist()]
        right_root[columns] = [self.find(x) for x in right[columns].tolist()]
        apart = left_root[a] != right_root[b]
        return new + self._link(left[a[apart]], right[b[apart]])

    def _link(self, a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
        return [(u, v) for u, v in zip(a.tolist(), b.tolist(), strict=True) if self.link(u, v)]


def links_between(left: list[np.ndarray], right: list[np.ndarray], radius: int, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places (in left, in right) of linked nodes, strip by strip.

    Each side is [fp], or PRINTS, size and node.
    """
    x, y = left[0].view(np.uint64), right[0].view(np.uint64)
    height = max(1, STRIP // max(1, len(y)))
    for i in range(0, len(x), height):
        near = np.bitwise_count(x[i : i + height, None] ^ y[None, :]) <= radius
        a, b = np.nonzero(near)
        a += i
        if same:
            a, b = a[a < b], b[a < b]
        if len(left) > 1 and len(a):
            differ = np.zeros(len(a), dtype=np.int64)
            for i in range(len(PRINTS)):
                differ += np.bitwise_count(left[i].view(np.uint64)[a] ^ right[i].view(np.uint64)[b])
            m, n = left[-2][a], right[-2][b]
            fits = (differ <= SIMILAR_BITS) & (np.minimum(m, n) >= SIMILARITY * np.maximum(m, n))
            a, b = a[fits], b[fits]
        if len(a):
            yield a, b


def link_edges(distinct: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """Edges (u, v) between distinct nodes that keep all components whole.

    ``distinct``: column fp, or PRINTS, size, node.  The edges are a spanning forest
    for each task.
    """
    small_batches(distinct.sparkSession)
    columns = ["fp"] if "node" not in distinct.columns else [*PRINTS, "size", "node"]
    wide = "node" in columns
    parts, steps = (_ranges(radius), _steps(1, 2, 2)) if wide else (_counts(4), _steps(radius, radius, 4))
    coded = distinct.select(*columns, _code(parts).alias("code"))
    # At most 17 to the 4th power combinations, or 65 by 100, so this side may be broadcast.
    sized = coded.groupBy("code").agg(F.ceil(F.count(F.lit(1)) / F.lit(tile)).cast("int").alias("n_tiles"))
    dealt = coded.join(F.broadcast(sized), "code").withColumn("tile", F.pmod(F.xxhash64(columns[-1]), F.col("n_tiles")).cast("int"))
    tiles = cut(dealt.groupBy("code", "tile").agg(F.sort_array(F.collect_list(F.struct(*columns))).alias("rows")), "tiles")
    shift = F.array(*[F.lit(_shifted(d)) for d in steps])
    # Which tiles meet is settled on their names; every tile is then a join key of its own,
    # so the tiles of a common population count are spread over the tasks.
    names = tiles.select("code", "tile")
    met = names.select(F.col("code").alias("left_code"), F.col("tile").alias("left_tile"), F.explode(shift).alias("step")).join(
        F.broadcast(sized), F.col("left_code") + F.col("step") == F.col("code")
    )
    named = met.select("left_code", "left_tile", "step", "code", F.explode(F.sequence(F.lit(0), F.col("n_tiles") - 1)).alias("tile"))
    wanted = named.filter((F.col("step") != 0) | (F.col("left_tile") <= F.col("tile")))
    lefts = tiles.select(F.col("code").alias("left_code"), F.col("tile").alias("left_tile"), F.col("rows").alias("left_rows"))
    same = (F.col("step") == 0) & (F.col("left_tile") == F.col("tile"))
    pairs = wanted.join(lefts, ["left_code", "left_tile"]).join(tiles.withColumnRenamed("rows", "right_rows"), ["code", "tile"]).select(
        same.alias("same"), "left_rows", "right_rows"
    )
    schema = pa.schema([("u", pa.int64()), ("v", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest, found = Forest(), []
        for batch in batches:
            for same, left, right in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2), strict=True):
                sides = [[side.values.field(i).to_numpy(zero_copy_only=False) for i in range(len(columns))] for side in (left, right)]
                for a, b in links_between(*sides, radius, same):
                    found += forest.link_all(sides[0][-1], sides[1][-1], a, b)
            if len(found) > FOREST:
                yield record_batch({"u": [x[0] for x in found], "v": [x[1] for x in found]}, schema)
                forest, found = Forest(), []
        yield record_batch({"u": [x[0] for x in found], "v": [x[1] for x in found]}, schema)

    return pairs.mapInArrow(run, "u long, v long")


def near_duplicate_groups(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id: a row per row of ``docs``.

    component_id is the smallest doc_id that links of at most ``radius`` differing
    bits reach.  An empty table gives an empty result.
    """
    known = cut(fingerprints(docs, shingle), "fingerprints")
    return _with_components(known, radius)


def _components(known: DataFrame, radius: int, tile: int = TILE) -> DataFrame:
    """node, root (which names a component even where ids are null), component_id."""
    prints = [c for c in (*PRINTS, "size") if c in known.columns]
    classes = cut(known.groupBy("node", *prints).agg(F.min("doc_id").alias("rep")), "classes")
    distinct = classes.select("fp") if prints == ["fp"] else classes.select(*prints, "node")
    roots = connected_components(link_edges(distinct, radius, tile))
    joined = classes.withColumnRenamed("node", "own").join(roots, F.col("own") == F.col("node"), "left")
    rooted = cut(joined.select(F.col("own").alias("node"), "rep", F.coalesce("root", "own").alias("root")), "rooted")
    # Tables on both sides, so that the join can be split where a group is very large.
    named = cut(rooted.groupBy("root").agg(F.min("rep").alias("component_id")), "named")
    return rooted.join(named, "root").select("node", "root", "component_id")


def _with_components(known: DataFrame, radius: int) -> DataFrame:
    known = known.withColumn("node", F.col("fp"))
    return known.join(_components(known, radius), "node").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def _first_of_each(docs: DataFrame, known: DataFrame, components: DataFrame) -> DataFrame:
    """``known``: doc_id, mark, node of every row of ``docs``."""
    first = F.col("doc_id").eqNullSafe(F.col("component_id"))
    firsts = known.join(components, "node").filter(first).groupBy("root").agg(F.min(F.struct("node", "mark", "doc_id")).alias("kept"))
    # Structs, so that a null id equals another and one exchange serves both steps.
    keys = firsts.select(F.struct(F.col("kept.doc_id").alias("doc_id"), F.col("kept.mark").alias("mark")).alias("key"))
    # The columns go in a struct, where no name can clash.
    row = F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row")
    key = F.struct(docs["doc_id"].cast("long").alias("doc_id"), _text_mark(docs).alias("mark")).alias("key")
    return docs.select(row, key).join(keys, "key", "left_semi").dropDuplicates(["key"]).select("row.*")


def keep_first(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """One row of ``docs``, all columns, for each group: one that has its smallest doc_id.

    Where several rows of a group have that doc_id, or all its ids are null, the least
    fingerprint decides, then a hash of the text and of the other columns; of rows that
    are equal in all, one stays.  A row of another text with the same doc_id, in whatever
    group, is judged by its own group.
    """
    known = cut(fingerprints(docs, shingle).withColumn("node", F.col("fp")), "fingerprints")
    return _first_of_each(docs, known, _components(known, radius))


def keep_similar(docs: DataFrame, shingle: int = SIMILAR_SHINGLE, radius: int = SIMILAR_RADIUS) -> DataFrame:
    """As ``keep_first``, for groups of documents whose sets of shingles are alike."""
    known = cut(similar_fingerprints(docs, shingle), "fingerprints")
    return _first_of_each(docs, known, _components(known, radius, SIMILAR_TILE))
