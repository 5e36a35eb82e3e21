"""A Merkle manifest of a collection, with a proof for every row (operator 11).

A row's leaf is the SHA-256 of its columns, each with its length.  The leaves of a
language (``tree``) ascend by doc_id; every run of eight consecutive nodes becomes
one of the next level until one remains, the subroot; the subroots, in the order of
their languages, are joined likewise into the root.  A proof lists, level by level,
what stands left and right of a node in its run, so one row and its proof are enough
to recompute the root.

Method: Merkle traversal scheduling.  Leaves are sorted by ranges and numbered, so
blocks of ``FANOUT ** BLOCK_LEVELS`` of them are aligned with the tree.  A treehash
stack turns a block into its top node; the tops are the leaves of the next layer,
which is a ``FANOUT ** BLOCK_LEVELS`` times smaller table, until a tree has one node.
Then, from the top layer down, each block is traversed leaf by leaf: every level
keeps the run that the path goes through now, and a treehash stack that takes in one
leaf of the run after it at each step, so the next run is ready when the path gets
there.  That is memory in the logarithm of the block beside the block's own digests.
The upper part of a path is the same for a whole block and is appended to it.

A block is a row of bounded size with a key of its own, so neither a hot language
nor a large group of copies gathers in a task; no digest comes to the driver.

Null columns count as ``-`` in a leaf.  A null language is a tree of its own and the
first one; null doc_ids come first in theirs.  Rows with one doc_id stand in the
order of their leaves; rows that agree in all are leaves of their own, each with its
own proof.  Empty texts and texts of any length are hashed whole.  An empty table
gives an empty result.  Columns beyond those hashed are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import LOWER, UPPER, cut, small_batches

FANOUT = 8
#: Levels of a block: 512 leaves.
BLOCK_LEVELS = 3
#: The columns of a leaf, in order.
HASHED = ("doc_id", "source", "lang", "n_chars", "text")
PROOF = "array<struct<left:string,right:string>>"


def leaf_digest(columns: list[Column]) -> Column:
    """SHA-256 of the values, each as its UTF-8 length, ``:`` and itself, or ``-``."""
    parts = []
    for c in columns:
        value = c.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def _node(children: list[bytes]) -> bytes:
    return sha256(b"".join(children)).hexdigest().encode()


class Treehash:
    """Nodes of height ``height`` over leaves that come one by one.

    A stack of runs, one for each level: a run that is full becomes a node of the next.
    """

    def __init__(self, height: int):
        self.runs: list[list[bytes]] = [[] for _ in range(height + 1)]

    def add(self, leaf: bytes) -> None:
        runs, level = self.runs, 0
        runs[0].append(leaf)
        while level + 1 < len(runs) and len(runs[level]) == FANOUT:
            runs[level + 1].append(_node(runs[level]))
            runs[level] = []
            level += 1

    def closed(self) -> list[bytes]:
        """The nodes, after short runs at the end of the leaves were closed."""
        for level in range(len(self.runs) - 1):
            if self.runs[level]:
                self.runs[level + 1].append(_node(self.runs[level]))
                self.runs[level] = []
        return self.runs[-1]


def top_of(leaves: list[bytes], height: int) -> bytes:
    tree = Treehash(height)
    for leaf in leaves:
        tree.add(leaf)
    return tree.closed()[0]


def traverse(leaf: Callable[[int], bytes], n: int, height: int) -> Iterator[list[tuple[bytes, bytes]]]:
    """For each of ``n`` leaves in order: what is left and right of its path, by level.

    ``leaf`` gives the leaf at a place.  No more than ``FANOUT`` nodes a level are kept,
    in each of ``height`` runs and as many treehash stacks.
    """
    spans = [FANOUT ** (level + 1) for level in range(height)]
    ahead = [Treehash(level) for level in range(height)]
    runs: list[list[bytes]] = []
    for level, span in enumerate(spans):
        first = Treehash(level)
        for i in range(min(span, n)):
            first.add(leaf(i))
        runs.append(first.closed())
    steps: list[tuple[bytes, bytes]] = [(b"", b"")] * height
    for i in range(n):
        for level, span in enumerate(spans):
            if i and i % span == 0:
                runs[level] = ahead[level].closed()
                ahead[level] = Treehash(level)
            if i + span < n:
                ahead[level].add(leaf(i + span))
            width = span // FANOUT
            if i % width == 0:
                run, at = runs[level], i // width % FANOUT
                steps[level] = b"".join(run[:at]), b"".join(run[at + 1 :])
        yield steps


def levels_of(n: int) -> int:
    """Levels of a whole tree of ``n`` leaves."""
    levels = 0
    while n > 1:
        n, levels = -(-n // FANOUT), levels + 1
    return levels


def _numbered(rows: DataFrame, order: list[Column], name: str) -> DataFrame:
    """``rows`` with ``at`` (place in its tree, from 0, by ``order``) and ``n`` (leaves of the tree).

    Rows are sorted by ranges and written with the partition and number they got there;
    only the totals of a partition and tree are summed up, one row for each.
    """
    placed = rows.repartitionByRange(F.asc_nulls_first("tree"), *order).sortWithinPartitions(F.asc_nulls_first("tree"), *order)
    mark = F.monotonically_increasing_id()
    ranges = cut(placed.select("*", F.shiftrightunsigned(mark, 33).cast("int").alias("part"), mark.bitwiseAND((1 << 33) - 1).alias("row")), name)
    before = Window.partitionBy("tree").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = ranges.groupBy("tree", "part").agg(F.min("row").alias("first"), F.count(F.lit(1)).alias("own"))
    starts = sums.select("tree", "part", "first", F.coalesce(F.sum("own").over(before), F.lit(0)).alias("start"), F.sum("own").over(Window.partitionBy("tree")).alias("n"))
    met = ranges.join(starts, ["tree", "part"])
    return met.select(*[c for c in ranges.columns if c not in ("part", "row")], (F.col("start") + F.col("row") - F.col("first")).alias("at"), "n")


def _blocks(rows: DataFrame, carried: list[str], name: str) -> DataFrame:
    """tree, block, n, rows: up to ``FANOUT ** BLOCK_LEVELS`` structs (at, digest, ``carried``) in order."""
    block = F.floor(F.col("at") / F.lit(FANOUT**BLOCK_LEVELS)).cast("long").alias("block")
    item = F.struct("at", "digest", *carried)
    held = rows.groupBy("tree", block).agg(F.max("n").alias("n"), F.sort_array(F.collect_list(item)).alias("rows"))
    return cut(held, name)


def _height(n: int, most: int) -> int:
    """Levels inside a block, ``most`` at most, of a tree of ``n`` leaves: the whole tree's if it is one block."""
    return levels_of(n) if n <= FANOUT**most else most


def _tops(blocks: DataFrame) -> DataFrame:
    """tree, at, digest: the top of each block, numbered as the next layer's leaves."""
    kind, most = blocks.schema["tree"].dataType, BLOCK_LEVELS
    given = blocks.select("tree", "block", "n", F.col("rows.digest").alias("digests"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tops = [
                top_of([x.encode() for x in digests], _height(n, most)).decode()
                for n, digests in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array(tops, pa.string())], names=["tree", "at", "n", "digest"])

    made = given.mapInArrow(run, f"tree {kind.simpleString()}, at long, n long, digest string")
    return made.select("tree", "at", F.ceil(F.col("n") / F.lit(FANOUT**BLOCK_LEVELS)).cast("long").alias("n"), "digest")


def _proofs(blocks: DataFrame, upper: DataFrame | None, carried: list[str]) -> DataFrame:
    """tree, at, digest, ``carried``, proof of every row of the blocks.

    ``upper``: tree, block, proof of the block's top; none where the blocks are whole trees.
    """
    kinds = {f.name: f.dataType.simpleString() for f in blocks.schema["rows"].dataType.elementType}
    given = blocks if upper is None else blocks.join(upper.withColumnRenamed("proof", "above"), ["tree", "block"])
    above = F.array().cast(PROOF) if upper is None else F.col("above")
    given = given.select("tree", "n", "rows", above.alias("above"))
    kind, most = blocks.schema["tree"].dataType.simpleString(), BLOCK_LEVELS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                rows, n = batch.column(2)[i].values, batch.column(1)[i].as_py()
                digests = [x.encode() for x in rows.field("digest").to_pylist()]
                shared = [(x["left"].encode(), x["right"].encode()) for x in batch.column(3)[i].as_py()]
                left, right, ends = [], [], [0]
                for steps in traverse(digests.__getitem__, len(digests), _height(n, most)):
                    for a, b in (*steps, *shared):
                        left.append(a)
                        right.append(b)
                    ends.append(len(left))
                sides = [pa.array(x, pa.binary()).cast(pa.string()) for x in (left, right)]
                proof = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(sides, names=["left", "right"]))
                tree = batch.column(0).take(pa.array([i] * len(digests)))
                own = [rows.field(c) for c in ("at", "digest", *carried)]
                yield pa.RecordBatch.from_arrays([tree, *own, proof], names=["tree", "at", "digest", *carried, "proof"])

    columns = ", ".join(f"`{c}` {kinds[c]}" for c in ("at", "digest", *carried))
    return given.mapInArrow(run, f"tree {kind}, {columns}, proof {PROOF}")


def _forest(rows: DataFrame, order: list[Column], carried: list[str], name: str) -> tuple[DataFrame, DataFrame, list[DataFrame]]:
    """Subroots (tree, subroot), the layer of leaves, and the layers above it, of the trees of ``rows``.

    ``rows``: tree (a struct), digest and ``carried``.
    """
    bottom = _blocks(_numbered(rows, order, f"{name}-sorted"), carried, f"{name}-0")
    layers, tops = [], cut(_tops(bottom), f"{name}-tops-0")
    roots = tops.filter("n = 1")
    while tops.filter("n > 1").limit(1).count():
        layers.append(_blocks(tops.filter("n > 1"), [], f"{name}-{len(layers) + 1}"))
        tops = cut(_tops(layers[-1]), f"{name}-tops-{len(layers)}")
        roots = roots.unionByName(tops.filter("n = 1"))
    return roots.select("tree", F.col("digest").alias("subroot")), bottom, layers


def _upper_proofs(layers: list[DataFrame], ends: DataFrame | None) -> DataFrame | None:
    """tree, block, proof of the tops of the lowest blocks; ``ends``: tree, proof of its subroot."""
    # A tree with one block in a layer ends there: its top is the subroot.
    above = None if ends is None else ends.select("tree", F.lit(0).cast("long").alias("block"), "proof")
    if not layers:
        return above
    found = above
    for layer in reversed(layers):
        found = _proofs(layer, found, []).select("tree", F.col("at").alias("block"), "proof")
        if above is not None:
            # Trees of this layer have more than one block below it; the others end below.
            found = found.unionByName(above.join(layer.select("tree").distinct(), "tree", "left_anti"))
        found = cut(found, "upper")
    return found


def merkle_manifest(docs: DataFrame, carried: dict[str, Column] | None = None) -> DataFrame:
    """doc_id, lang, leaf, subroot, root, proof (left and right by level), and ``carried``: a row per row of ``docs``.

    ``docs``: the columns HASHED.  ``carried``: further columns, of ``docs``.
    """
    small_batches(docs.sparkSession)
    more = carried or {}
    rows = docs.select(
        F.struct(docs["lang"].cast("string").alias("lang")).alias("tree"),
        docs["doc_id"].cast("long").alias("doc_id"),
        leaf_digest([docs[c] for c in HASHED]).alias("digest"),
        *[c.alias(name) for name, c in more.items()],
        F.monotonically_increasing_id().alias("row_mark"),
    )
    # Written first: what is sorted by ranges must not change between sampling and sorting.
    rows = cut(rows, "leaves")
    order = [F.asc_nulls_first("doc_id"), F.col("digest"), F.col("row_mark")]
    subroots, bottom, layers = _forest(rows, order, ["doc_id", *more], "leaves")
    subroots = cut(subroots, "subroots")
    # The subroots are the leaves of one tree more, in the order of their languages.
    one = subroots.select(F.struct(F.lit(0).alias("top")).alias("tree"), F.col("subroot").alias("digest"), F.col("tree").alias("key"))
    top, top_bottom, top_layers = _forest(one, [F.asc_nulls_first("key")], ["key"], "top")
    root = top.first()
    ends = cut(_proofs(top_bottom, _upper_proofs(top_layers, None), ["key"]).select(F.col("key").alias("tree"), "proof"), "ends")
    found = _proofs(bottom, _upper_proofs(layers, ends), ["doc_id", *more])
    named = found.join(subroots, "tree")
    return named.select(
        "doc_id", F.col("tree.lang").alias("lang"), F.col("digest").alias("leaf"), "subroot", F.lit(root["subroot"] if root else None).cast("string").alias("root"), "proof", *more
    )


def folded(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and a proof give."""
    return F.aggregate(proof, leaf, lambda node, step: F.sha2(F.concat(step["left"], node, step["right"]), 256))


def proof_digest(proof: Column) -> Column:
    """SHA-256 of a proof's digests, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(proof, lambda step: F.concat(step["left"], step["right"])), ""), 256)


def tampered_text(docs: DataFrame) -> Column:
    """The text with A-Z lower-cased where 3 divides the CRC-32 of the doc_id; else as it is."""
    hit = F.crc32(docs["doc_id"].cast("long").cast("string").cast("binary")) % 3 == 0
    return F.when(hit, F.translate(docs["text"].cast("string"), UPPER, LOWER)).otherwise(docs["text"].cast("string"))


def verified_manifest(docs: DataFrame, text: Column) -> DataFrame:
    """The manifest of ``docs``, and what its proofs say of the rows as they are with ``text``.

    doc_id, leaf, subroot, root, proof_sha256, folded_root, verified (folded_root equals root).
    """
    now = leaf_digest([text if c == "text" else docs[c] for c in HASHED])
    made = merkle_manifest(docs, {"leaf_now": now})
    again = made.withColumn("folded_root", folded(F.col("leaf_now"), F.col("proof")))
    return again.select(
        "doc_id", "leaf", "subroot", "root", proof_digest(F.col("proof")).alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified")
    )
