"""Merkle manifest of a data set; tree blocks are stored in van Emde Boas order.

A leaf is the SHA-256 of a row's fields, each ``-`` if null, else its UTF-8 byte count, ``:`` and its value. Leaves of one tree (here: of one
source) stand in order; while several nodes remain, every ``ARITY`` consecutive ones become the SHA-256 of their digests as hex text.
The roots of the trees, in order of their sources, are the leaves of one more such tree, whose root stands for the data set.

A tree is cut into aligned blocks of ``LEVELS`` levels. A block's nodes are stored as one array in van Emde Boas order: the block is split
at half its height, its top subtree comes first, then its bottom subtrees from left to right, each in the same order again.
``address`` finds a node's place by arithmetic alone, also in a block that is not full; blocks are filled and siblings are
fetched through it. The roots of the blocks are the leaves of the next round of blocks, until each tree has one.

Scale: texts are read and hashed in one pass, only digests go on. Rows are sorted by range; a row's index is its place in the sorted
partition plus the rows of its tree in the partitions before, so a source of any size is spread over many tasks. One task holds one
block (4,096 leaves) at a time. Paths go down from the root once per block, not per row: a block's array and its path meet its leaves
in the task that proves them.

Defined results: null fields count as ``-``; a null text differs from an empty one; a null source is a tree of its own, before all others;
null doc_ids come first in their source; of rows with the same doc_id the one of the smaller digest comes first, so equal rows
change places without effect; a table of one row is its own root; an empty table gives an empty result and no root; other columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import table, written

ARITY, LEVELS = 16, 4
#: Leaves of a block.
WIDTH = ARITY ** (LEVELS - 1)
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
BLOCK = "tree string, block long, size int, nodes binary, root string"
PATH = "array<struct<before:string,after:string>>"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def digest(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def level_sizes(leaves: int, lone: bool) -> list[int]:
    """Nodes of a block on each level, its root's first. A tree's only block ends where one node is left."""
    sizes = [leaves]
    while len(sizes) < LEVELS and not (lone and sizes[-1] == 1):
        sizes.append(-(-sizes[-1] // ARITY))
    return sizes[::-1]


def address(sizes: list[int], level: int, index: np.ndarray) -> np.ndarray:
    """Places of nodes ``index`` of a level in a block's van Emde Boas array; nodes that a block lacks take no place."""
    index = np.asarray(index, np.int64)
    place, root = np.zeros(len(index), np.int64), np.zeros(len(index), np.int64)
    top, height = 0, len(sizes)
    while height > 1:
        middle = top + height // 2
        if level < middle:
            height = middle - top
            continue
        for at in range(top, middle):  # the top subtree
            place += np.minimum(sizes[at], (root + 1) * ARITY ** (at - top)) - np.minimum(sizes[at], root * ARITY ** (at - top))
        first, own = root * ARITY ** (middle - top), index // ARITY ** (level - middle)
        for at in range(middle, top + height):  # the bottom subtrees to the left
            place += np.minimum(sizes[at], own * ARITY ** (at - middle)) - np.minimum(sizes[at], first * ARITY ** (at - middle))
        root, height, top = own, top + height - middle, middle
    return place


@lru_cache(64)
def addresses(sizes: tuple[int, ...], level: int) -> np.ndarray:
    return address(list(sizes), level, np.arange(sizes[level]))


def fill(leaves: list[bytes], lone: bool) -> tuple[bytes, str]:
    """The array of a block over ``leaves`` (32 bytes each), and its root."""
    sizes = level_sizes(len(leaves), lone)
    out = np.zeros((sum(sizes), 32), np.uint8)
    nodes = [x.hex() for x in leaves]
    for level in range(len(sizes) - 1, -1, -1):
        out[addresses(tuple(sizes), level)] = np.frombuffer(bytes.fromhex("".join(nodes)), np.uint8).reshape(-1, 32)
        if level:
            nodes = [digest("".join(nodes[i : i + ARITY])) for i in range(0, len(nodes), ARITY)]
    return out.tobytes(), nodes[0]


class Block:
    """Sibling retrieval from a stored block, and the path above its root."""

    def __init__(self, number: int, size: int, nodes: bytes, path: list[dict]):
        self.sizes = tuple(level_sizes(size, lone=number == 0 and size < WIDTH))
        self.array = np.frombuffer(nodes, np.uint8).reshape(-1, 32)
        self.first, self.path = number * WIDTH, [(p["before"], p["after"]) for p in path or []]
        self.runs: dict[tuple[int, int], list[str]] = {}
        self.above: dict[int, str] = {}
        self.folds: dict[tuple[int, int, str], str] = {}

    def run(self, level: int, number: int) -> list[str]:
        """The digests of one run of siblings, fetched by their addresses."""
        if (level, number) not in self.runs:
            places = addresses(self.sizes, level)[number * ARITY : (number + 1) * ARITY]
            text = self.array[places].tobytes().hex()
            self.runs[level, number] = [text[i : i + 64] for i in range(0, len(text), 64)]
        return self.runs[level, number]

    def sides(self, level: int, index: int) -> tuple[str, str]:
        run, at = self.run(level, index // ARITY), index % ARITY
        return "".join(run[:at]), "".join(run[at + 1 :])

    def way(self, leaf: int) -> list[tuple[str, str]]:
        """The siblings before and after a leaf's path, level by level up to the root of all."""
        out, index = [], leaf
        for level in range(len(self.sizes) - 1, 0, -1):
            out.append(self.sides(level, index))
            index //= ARITY
        return out + self.path

    def siblings(self, leaf: int) -> str:
        if len(self.sizes) == 1:
            return "".join(a + b for a, b in self.path)
        group = leaf // ARITY
        if group not in self.above:  # what 16 neighbours share
            self.above[group] = "".join(a + b for a, b in self.way(leaf)[1:])
        before, after = self.sides(len(self.sizes) - 1, leaf)
        return before + after + self.above[group]

    def fold(self, level: int, index: int, node: str) -> str:
        """The root that ``node`` gives in its place, with the siblings as stored."""
        key = level, index, node
        if key not in self.folds:
            if level:
                before, after = self.sides(level, index)
                self.folds[key] = self.fold(level - 1, index // ARITY, digest(before + node + after))
            else:
                for before, after in self.path:
                    node = digest(before + node + after)
                self.folds[key] = node
        return self.folds[key]


# -- growing ---------------------------------------------------------------------------------------------------

def leaf_digest(text: str | Column = "text", fields: tuple[str, ...] = FIELDS) -> Column:
    """The leaf of a row (hex), with ``text`` in place of the field of that name."""
    def part(name: str) -> Column:
        value = (F.col(text) if isinstance(text, str) else text) if name == "text" else F.col(name)
        value = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))

    return F.sha2(F.concat(*map(part, fields)), 256)


def numbered(rows: DataFrame, order: list[str], name: str) -> DataFrame:
    """``rows`` with ``idx``, the place of a row within its ``tree`` in the given order, from 0.

    The last column of ``order`` must tell equal rows apart, so that any group can be split over partitions."""
    placed = written(rows.repartitionByRange("tree", *order).sortWithinPartitions("tree", *order).withColumn("place", F.monotonically_increasing_id()), name)
    placed = placed.withColumn("part", F.shiftright("place", 33))
    # A row for each tree and sorted partition.
    counts = placed.groupBy("tree", "part").agg(F.min("place").alias("first"), F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("tree").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = counts.select("tree", "part", (before - F.col("first")).alias("shift"))
    return placed.join(starts, ["tree", "part"]).withColumn("idx", F.col("place") + F.col("shift")).drop("place", "part", "shift")


def _fill_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (tree, block, node) to a row for each block."""
    done: list[tuple] = []
    key, leaves = None, []

    def close() -> None:
        if leaves:
            nodes, root = fill(leaves, lone=key[1] == 0 and len(leaves) < WIDTH)
            done.append((*key, len(leaves), nodes, root))

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        types = (pa.string(), pa.int64(), pa.int32(), pa.binary(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=["tree", "block", "size", "nodes", "root"])

    for batch in batches:
        for tree, block, node in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            if (tree, block) != key:
                close()
                key, leaves = (tree, block), []
                if len(done) >= 128:
                    yield batch_of(done)
                    done.clear()
            leaves.append(node)
    close()
    if done:
        yield batch_of(done)


def grow(nodes: DataFrame, name: str) -> tuple[list[DataFrame], DataFrame]:
    """(tree, idx, node) to the rounds of blocks (written tables), and (tree, root)."""
    rounds, roots = [], None
    while True:
        keyed = nodes.select("tree", F.floor(F.col("idx") / WIDTH).cast("long").alias("block"), "idx", "node")
        ordered = keyed.repartition("tree", "block").sortWithinPartitions("tree", "block", "idx").select("tree", "block", "node")
        blocks = written(ordered.mapInArrow(_fill_blocks, BLOCK), f"{name}-blocks")
        rounds.append(blocks)
        last = blocks.groupBy("tree").agg(F.max("block").alias("last"))
        whole = blocks.join(last.where("last = 0"), "tree", "left_semi").select("tree", "root")
        roots = whole if roots is None else roots.union(whole)
        rest = last.where("last > 0").select("tree")
        if not rest.take(1):
            return rounds, roots
        nodes = blocks.join(rest, "tree", "left_semi").select("tree", F.col("block").alias("idx"), F.unhex("root").alias("node"))


@dataclass
class Manifest:
    """``leaves(tree, idx, doc_id, leaf, shown)``, the rounds of blocks of all trees and of the tree over them, and the root (None
    for an empty table). ``places(tree, idx, root)``: each tree's root and its place among the trees."""

    leaves: DataFrame
    rounds: list[DataFrame]
    places: DataFrame
    over: list[DataFrame]
    root: str | None


def build(docs: DataFrame, shown: Column | None = None) -> Manifest:
    """The manifest of ``docs``. ``shown`` is a leaf digest (hex) that a holder of the row presents later, null if its own."""
    tree = F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit(""))  # null before all others
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), tree.alias("tree"), F.unhex(leaf_digest()).alias("leaf"), F.unhex(shown if shown is not None else F.lit(None).cast("string")).alias("shown"))
    # Hashed once, then sorted; the row's number only tells equal rows apart.
    hashed = written(rows.withColumn("row", F.monotonically_increasing_id()), "leaves")
    leaves = numbered(hashed, ["doc_id", "leaf", "row"], "sorted").drop("row")
    rounds, roots = grow(leaves.select("tree", "idx", F.col("leaf").alias("node")), "tree")
    names = roots.select(F.lit("").alias("tree"), F.col("tree").alias("name"), "root")
    places = written(numbered(names, ["name"], "roots").select(F.col("name").alias("tree"), "idx", "root"), "places")
    over, top = grow(places.select(F.lit("").alias("tree"), "idx", F.unhex("root").alias("node")), "over")
    root = top.first()
    return Manifest(leaves, rounds, places, over, root["root"] if root else None)


# -- proving ---------------------------------------------------------------------------------------------------

def _descend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks with their paths to (tree, idx, path) of each of their leaves."""
    for batch in batches:
        for row in batch.to_pylist():
            block = Block(row["block"], row["size"], row["nodes"], row["path"])
            for at in range(0, row["size"], 512):
                part = range(at, min(at + 512, row["size"]))
                paths = [[{"before": a, "after": b} for a, b in block.way(i)] for i in part]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["tree"]] * len(part), pa.string()), pa.array([block.first + i for i in part], pa.int64()),
                     pa.array(paths, pa.list_(pa.struct([("before", pa.string()), ("after", pa.string())])))], names=["tree", "idx", "path"])


def paths(rounds: list[DataFrame], tops: DataFrame) -> DataFrame:
    """(tree, block, path) of the first round's blocks; ``tops(tree, path)`` leads from each tree's root upwards."""
    found = None  # of the blocks of the round above
    for number in range(len(rounds) - 1, -1, -1):
        blocks = rounds[number]
        last = blocks.groupBy("tree").agg(F.max("block").alias("last"))
        now = last.where("last = 0").join(tops, "tree").select("tree", F.lit(0).cast("long").alias("block"), "path")
        if found is not None:
            now = now.union(found)
        if number:
            below = blocks.join(now, ["tree", "block"]).select("tree", "block", "size", "nodes", "path").mapInArrow(_descend, f"tree string, idx long, path {PATH}")
            found = written(below.withColumnRenamed("idx", "block"), "paths")
    return now


def _prove(root: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, subroot = None, None
        for batch in batches:
            rows: list[tuple] = []
            for number, idx, doc, leaf, shown, size, nodes, path, own in zip(*(batch.column(i).to_pylist() for i in range(9)), strict=True):
                if nodes is not None:
                    block, subroot = Block(number, size, nodes, path), own
                    continue
                at = idx - block.first
                name = leaf.hex()
                folded = block.fold(len(block.sizes) - 1, at, name if shown is None else shown.hex())
                rows.append((doc, name, subroot, root, digest(block.siblings(at)), folded, folded == root))
            if rows:
                types = (pa.int64(), *[pa.string()] * 5, pa.bool_())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=PROOF_NAMES)
    return run


PROOF = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
PROOF_NAMES = [x.split(" ")[0] for x in PROOF.split(", ")]


def proofs(manifest: Manifest) -> DataFrame:
    """Per row its leaf, the roots, the digest of its siblings up to the root, and the root that the shown (else own) leaf folds to."""
    spark = manifest.leaves.sparkSession
    if manifest.root is None:
        return spark.createDataFrame([], PROOF)
    # The root itself has no path.
    upper = paths(manifest.over, manifest.over[-1].select("tree", F.array().cast(PATH).alias("path")))
    upper = manifest.over[0].join(upper, ["tree", "block"]).select("tree", "block", "size", "nodes", "path").mapInArrow(_descend, f"tree string, idx long, path {PATH}")
    tops = written(manifest.places.join(upper.select("idx", "path"), "idx").select("tree", "path"), "tops")
    ways = paths(manifest.rounds, tops)
    blocks = manifest.rounds[0].drop("root").join(ways, ["tree", "block"]).join(manifest.places.select("tree", "root"), "tree")
    heads = blocks.select("tree", "block", F.lit(-1).cast("long").alias("idx"), F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("binary").alias("leaf"),
                          F.lit(None).cast("binary").alias("shown"), "size", "nodes", "path", "root")
    rows = manifest.leaves.select("tree", F.floor(F.col("idx") / WIDTH).cast("long").alias("block"), "idx", "doc_id", "leaf", "shown", F.lit(None).cast("int").alias("size"),
                                  F.lit(None).cast("binary").alias("nodes"), F.lit(None).cast(PATH).alias("path"), F.lit(None).cast("string").alias("root"))
    # A block goes before its leaves.
    met = heads.union(rows).repartition("tree", "block").sortWithinPartitions("tree", "block", "idx").drop("tree")
    return met.mapInArrow(_prove(manifest.root), PROOF)


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    tampered = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))
    lowered = leaf_digest(F.translate("text", UPPER, LOWER))
    return proofs(build(table(spark, sf_dir, "documents"), F.when(tampered, lowered)))


# -- the DuckDB twin -------------------------------------------------------------------------------------------

#: Levels that the twin can climb: 16^5 rows of a source, 16^3 sources.
SQL_LEVELS, SQL_TOP_LEVELS = 5, 3


def _sql() -> str:
    def field(name: str, value: str) -> str:
        return f"coalesce(CAST(strlen(CAST({value} AS VARCHAR)) AS VARCHAR) || ':' || CAST({value} AS VARCHAR), '-')"

    def leaf(text: str) -> str:
        return "sha256(" + " || ".join(field(x, text if x == "text" else x) for x in FIELDS) + ")"

    def climb(name: str, levels: int) -> str:
        out = []
        for k in range(levels):
            out.append(f"""
{name}_runs{k} AS (
  SELECT tree, idx // {ARITY} AS run, list(d ORDER BY idx) AS ds, any_value(c) AS c
  FROM (SELECT *, count(*) OVER (PARTITION BY tree) AS c FROM {name}{k}) GROUP BY tree, run
),
{name}{k + 1} AS (
  SELECT tree, run AS idx, CASE WHEN c = 1 THEN ds[1] ELSE sha256(array_to_string(ds, '')) END AS d FROM {name}_runs{k}
)""")
        return ",".join(out)

    def fold(name: str, levels: int, source: str, at: str) -> str:
        out = []
        for k in range(levels):
            place = f"f.{at} // {ARITY ** k} % {ARITY}"
            out.append(f"""
{name}_fold{k} AS (
  SELECT f.* REPLACE (CASE WHEN r.c > 1 THEN f.proof || before || after ELSE f.proof END AS proof,
                      CASE WHEN r.c > 1 THEN sha256(before || f.cur || after) ELSE f.cur END AS cur)
  FROM {source if not k else f"{name}_fold{k - 1}"} f
  JOIN {name}_runs{k} r ON r.tree = {"f.tree" if name == "n" else "''"} AND r.run = f.{at} // {ARITY ** (k + 1)},
  LATERAL (SELECT array_to_string(r.ds[1:{place}], '') AS before, array_to_string(r.ds[{place} + 2:], '') AS after)
)""")
        return ",".join(out)

    crc = """
bits AS (
  SELECT i, i AS c, 0 AS k FROM range(256) t(i)
  UNION ALL
  SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM bits WHERE k < 8
),
walk AS (
  SELECT DISTINCT doc_id AS id, CAST(doc_id AS VARCHAR) AS s, CAST(4294967295 AS BIGINT) AS c, 1 AS k FROM documents WHERE doc_id IS NOT NULL
  UNION ALL
  SELECT w.id, w.s, xor(w.c >> 8, b.c), w.k + 1 FROM walk w JOIN bits b ON b.k = 8 AND b.i = xor(w.c, CAST(ord(w.s[w.k]) AS BIGINT)) & 255
  WHERE w.k <= length(w.s)
),
tampered AS (SELECT id FROM walk WHERE k = length(s) + 1 AND xor(c, 4294967295) % 5 = 0)"""
    return f"""
WITH RECURSIVE {crc.strip()},
leaves AS (
  SELECT doc_id, coalesce('=' || source, '') AS tree, {leaf("text")} AS leaf,
         CASE WHEN doc_id IN (SELECT id FROM tampered) THEN {leaf(f"translate(text, '{UPPER}', '{LOWER}')")} END AS shown
  FROM documents
),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx FROM leaves
),
n0 AS (SELECT tree, idx, leaf AS d FROM placed),{climb("n", SQL_LEVELS)},
roots AS (SELECT tree AS name, d, row_number() OVER (ORDER BY tree) - 1 AS sno FROM n{SQL_LEVELS}),
t0 AS (SELECT '' AS tree, sno AS idx, d FROM roots),{climb("t", SQL_TOP_LEVELS)},
starts AS (SELECT p.*, r.sno, r.d AS subroot, '' AS proof, coalesce(p.shown, p.leaf) AS cur FROM placed p JOIN roots r ON r.name = p.tree),{fold("n", SQL_LEVELS, "starts", "idx")},{fold("t", SQL_TOP_LEVELS, f"n_fold{SQL_LEVELS - 1}", "sno")}
SELECT doc_id, leaf, subroot, d AS root, sha256(proof) AS proof_sha256, cur AS folded_root, cur = d AS verified
FROM t_fold{SQL_TOP_LEVELS - 1}, t{SQL_TOP_LEVELS}
"""


SQL = _sql()
