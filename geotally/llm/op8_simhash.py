"""Near duplicates by SimHash fingerprints and a binary-trie self-join.

Fingerprint: each shingle of ``width`` words (ASCII lower case; fewer words: all of them) is hashed with XXH64, seed 42;
a bit is 1 if it is set in over half of the shingles' hashes, repeats included. No words: fingerprint zero.

The trie holds each distinct fingerprint once. Two fingerprints within ``distance`` bits agree on one of
``distance + 1`` equal blocks of bits, so the trie is traversed once per block, turned so that the block comes first,
and only from the pairs of a node with itself at the block's depth: there no bit differs yet. From a pair of nodes
the traversal goes to the pairs of their children, adds a differing bit where the branches differ, and drops a pair
beyond the budget. A node of too many fingerprints for one task is split before that, in Spark, into the pairs of its
descendants ``STEP`` bits below, as often as needed. A task returns only a spanning forest of the links that it
found, and the forests meet in connected components: no group of copies is ever expanded into all pairs.

Defined results: null text counts as empty; documents without words share fingerprint zero and are linked like any
other; repeated rows get one row each; a null doc_id never names a component unless it has no other; an empty table
gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table, worker_cache, written
from .graph import components

WIDTH, DISTANCE, SEED = 3, 3, 42
#: Fingerprints under one node pair that a task may traverse; larger nodes are split by this many further bits.
NODE_ROWS, STEP = 1024, 8
CHUNK_ROWS = 1 << 18
#: Shingles whose bits are added up at a time.
SHINGLES = 1 << 14


def fingerprint(text: bytes | None, width: int = WIDTH) -> int:
    import xxhash

    words = (text or b"").lower().split()
    if not words:
        return 0
    if len(words) < width:
        shingles = iter([b" ".join(words)])
    else:
        shingles = map(b" ".join, zip(*(islice(words, i, None) for i in range(width)), strict=False))
    digest = xxhash.xxh64_intdigest
    ones, count = np.zeros(64, np.int64), 0
    while hashes := [digest(x, SEED) for x in islice(shingles, SHINGLES)]:
        bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(0, dtype=np.int64)
        count += len(hashes)
    return int(np.packbits(ones * 2 > count, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, width: int = WIDTH, text_hash: bool = False) -> DataFrame:
    """doc_id and fp (the fingerprint as a signed long) of every row, and version (the text's hash) if asked for."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_cache("fingerprints")  # what an operator before this one remembered goes
        for batch in batches:
            found = np.array([fingerprint(t.as_py(), width) for t in batch.column(1)], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64)), *batch.columns[2:]], names=["doc_id", "fp", *batch.schema.names[2:]])

    version = [F.xxhash64(F.coalesce("text", F.lit(""))).alias("version")] if text_hash else []
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"), *version)
    return source.mapInArrow(run, "doc_id long, fp long" + ", version long" * text_hash)


def traverse(values: np.ndarray, pairs: list[np.ndarray], depth: int, budget: int) -> tuple[np.ndarray, np.ndarray]:
    """All index pairs of sorted distinct ``values`` within ``budget`` differing bits, from the given node pairs.

    ``pairs``: [a, a end, b, b end, differing bits], nodes as ranges of ``values``; a node may be paired with itself.
    """
    out_a, out_b = [], []
    a0, a1, b0, b1, spent = (x.astype(np.int64) for x in pairs)
    for level in range(depth, 64):
        live = (a0 < a1) & (b0 < b1) & ~((a0 == b0) & (a1 - a0 == 1)) & (spent <= budget)
        single = live & (a1 - a0 == 1) & (b1 - b0 == 1)
        if single.any():
            out_a.append(a0[single])
            out_b.append(b0[single])
        keep = live & ~single
        a0, a1, b0, b1, spent = a0[keep], a1[keep], b0[keep], b1[keep], spent[keep]
        if not len(a0):
            break
        # Ranges are sorted, so the next bit cuts each in two; the cut is the number of values with the bit off.
        off = np.concatenate(([0], np.cumsum(((values >> np.uint64(63 - level)) & np.uint64(1)) == 0)))
        am, bm = a0 + off[a1] - off[a0], b0 + off[b1] - off[b0]
        twin = a0 == b0
        other = ~twin
        a0, a1, b0, b1, spent = (np.concatenate(x) for x in (
            (a0, am, a0, am[other]), (am, a1, am, a1[other]), (b0, bm, bm, b0[other]), (bm, b1, b1, bm[other]),
            (spent, spent, spent + 1, spent[other] + 1)))
    else:
        live = (a0 < a1) & (b0 < b1) & (spent <= budget) & (a0 != b0)
        out_a.append(a0[live])
        out_b.append(b0[live])
    a, b = (np.concatenate([np.empty(0, np.int64), *x]) for x in (out_a, out_b))
    near = np.bitwise_count(values[a] ^ values[b]) <= budget
    return a[near], b[near]


def forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest index reachable from each of ``n`` nodes."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        fresh = label.copy()
        np.minimum.at(fresh, label[a], low)
        np.minimum.at(fresh, label[b], low)
        fresh = fresh[fresh]
        if (fresh == label).all():
            return label
        label = fresh


def linker(budget: int, depth: int):
    """Batches (turn, pair, side, turned fingerprint), sorted by the last three, to links (a, b) of fingerprints.

    ``depth``: how many leading bits are known to be equal within every pair."""
    def links(rows: list[np.ndarray]) -> pa.RecordBatch:
        turn, pair, side, turned = rows
        # Several node pairs are traversed at once: each side of each is a range of its own.
        starts = np.nonzero(np.concatenate(([True], (pair[1:] != pair[:-1]) | (side[1:] != side[:-1]))))[0]
        ends = np.concatenate((starts[1:], [len(pair)]))
        first, last = {}, {}
        for s, e in zip(starts.tolist(), ends.tolist(), strict=True):
            first.setdefault(pair[s], (s, e))
            last[pair[s]] = (s, e)
        nodes = np.array([[*first[k], *last[k], 0] for k in first], np.int64).T
        a, b = traverse(turned, list(nodes), depth, budget)
        label = forest(len(turned), a, b)
        moved = np.nonzero(label != np.arange(len(label)))[0]
        right = turn.astype(np.uint64)
        prints = (turned >> right) | np.where(right > 0, turned << (np.uint64(64) - right) % np.uint64(64), np.uint64(0))
        return pa.RecordBatch.from_arrays([pa.array(prints[i].view(np.int64)) for i in (moved, label[moved])], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []
        size = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = [batch.column(i).to_numpy() for i in range(4)]
            rows[3] = rows[3].view(np.uint64)
            held.append(rows)
            size += batch.num_rows
            if size >= CHUNK_ROWS:
                whole = [np.concatenate(x) for x in zip(*held, strict=True)]
                cut = int(np.nonzero(whole[1] != whole[1][-1])[0][-1]) + 1 if (whole[1] != whole[1][-1]).any() else 0
                if cut:
                    yield links([x[:cut] for x in whole])
                held = [[x[cut:] for x in whole]]
                size = len(whole[0]) - cut
        if size:
            yield links([np.concatenate(x) for x in zip(*held, strict=True)])
    return run


def near_links(fps: DataFrame, budget: int = DISTANCE, node_rows: int = NODE_ROWS) -> DataFrame:
    """Links (a, b) between distinct fingerprints ``fp`` whose components are those of all pairs within ``budget`` bits."""
    block = 64 // (budget + 1)
    turns = [i * block for i in range(budget + 1)]
    turned = fps.select("fp", F.explode(F.array(*map(F.lit, turns))).alias("turn"))
    left = F.expr("shiftleft(fp, turn) | case when turn > 0 then shiftrightunsigned(fp, 64 - turn) else 0 end")
    turned = written(turned.select("turn", left.alias("t")), "turned")

    def node(depth: int):
        return F.shiftrightunsigned("t", 64 - depth) if depth < 64 else F.col("t")

    # Node pairs: (turn, a, b, bits that differ so far); they start on the diagonal, at the depth of the block.
    def sized(depth: int) -> DataFrame:
        return turned.groupBy("turn", node(depth).alias("n")).agg(F.count("*").alias("rows"))

    depth, leaves = block, []
    pairs = sized(depth).where("rows > 1").select("turn", F.col("n").alias("a"), F.col("n").alias("b"), F.lit(0).alias("spent"), F.col("rows").alias("ra"), F.col("rows").alias("rb"))
    while True:
        small = F.greatest("ra", "rb") <= node_rows
        leaves.append((depth, pairs.where(small)))
        large = pairs.where(~small)
        if depth >= 64 or not (large := written(large, "nodes")).take(1):
            break
        step = min(STEP, 64 - depth)
        depth += step
        below = sized(depth).withColumn("parent", F.shiftrightunsigned("n", step))
        one = below.select("turn", F.col("parent").alias("a"), F.col("n").alias("ca"), F.col("rows").alias("na"))
        two = below.select("turn", F.col("parent").alias("b"), F.col("n").alias("cb"), F.col("rows").alias("nb"))
        children = large.join(one, ["turn", "a"]).join(two, ["turn", "b"]).where("a <> b or ca <= cb")
        spent = (F.col("spent") + F.bit_count(F.col("ca").bitwiseXOR(F.col("cb")) .bitwiseAND(F.lit((1 << step) - 1)))).cast("int")
        pairs = children.select("turn", F.col("ca").alias("a"), F.col("cb").alias("b"), spent.alias("spent"), F.col("na").alias("ra"), F.col("nb").alias("rb"))
        pairs = written(pairs.where((F.col("spent") <= budget) & ~((F.col("a") == F.col("b")) & (F.col("ra") == 1))), "nodes")

    found = None
    for at, leaf in leaves:
        rows = turned.withColumn("n", node(at))
        if at == block:
            # A node with itself: its fingerprints go to one task by the node's number.
            keyed = rows.join(leaf.select("turn", F.col("a").alias("n")), ["turn", "n"]).select("turn", F.xxhash64("turn", "n").alias("pair"), F.lit(0).alias("side"), "t")
        else:
            sides = leaf.select("turn", F.xxhash64("turn", "a", "b").alias("pair"), F.explode(F.when(F.col("a") == F.col("b"), F.array(F.struct(F.lit(0).alias("side"), F.col("a").alias("n")))).otherwise(
                F.array(F.struct(F.lit(0).alias("side"), F.col("a").alias("n")), F.struct(F.lit(1).alias("side"), F.col("b").alias("n"))))).alias("s")).select("turn", "pair", "s.side", "s.n")
            keyed = rows.join(sides, ["turn", "n"]).select("turn", "pair", "side", "t")
        ordered = keyed.repartition("pair").sortWithinPartitions("pair", "side", F.col("t").bitwiseXOR(F.lit(-(1 << 63))))
        part = ordered.mapInArrow(linker(budget, block if at == block else 0), "a long, b long")
        found = part if found is None else found.union(part)
    return found


def _components(prints: DataFrame, distance: int, node_rows: int) -> DataFrame:
    """fp, component (a fingerprint), component_id (smallest doc_id) of each distinct fingerprint of ``prints``, a written table."""
    distinct = written(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "distinct")
    linked = components(near_links(distinct.select("fp"), distance, node_rows))
    grouped = distinct.join(linked.withColumnRenamed("node", "fp"), "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    lowest = grouped.groupBy("component").agg(F.min("first_id").alias("component_id"))
    return grouped.join(lowest, "component").select("fp", "component", "component_id")


def near_duplicates(docs: DataFrame, width: int = WIDTH, distance: int = DISTANCE, node_rows: int = NODE_ROWS) -> DataFrame:
    """doc_id, fp, component_id (smallest doc_id reachable over links of at most ``distance`` bits) per document row."""
    prints = written(fingerprints(docs, width), "fingerprints")
    return prints.join(_components(prints, distance, node_rows).drop("component"), "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, width: int = WIDTH, distance: int = DISTANCE) -> DataFrame:
    """The documents without all but one of each component: the row of its smallest doc_id (null last; of several, the one of the
    smallest hash of its text), whatever other rows have the same doc_id."""
    prints = written(fingerprints(docs, width, text_hash=True), "fingerprints")
    place = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "version")
    # Least rows of each fingerprint first, so that only these meet the components.
    leasts = prints.groupBy("fp").agg(F.min(place).alias("place"))
    found = leasts.join(_components(prints, distance, NODE_ROWS), "fp").groupBy("component").agg(F.min("place").alias("place"))
    kept = found.select(F.col("place.doc_id").alias("__id"), F.col("place.version").alias("__version"))
    version = F.xxhash64(F.coalesce(docs["text"], F.lit("")))
    joined = docs.join(kept, docs["doc_id"].cast("long").eqNullSafe(F.col("__id")) & (version == F.col("__version")))
    # Rows of one doc_id and text are rare; one of them stays.
    several = written(joined.groupBy("__id", "__version").agg(F.count("*").alias("n")).where("n > 1").select(F.col("__id").alias("__i"), F.col("__version").alias("__v")), "several")
    same = F.col("__id").eqNullSafe(F.col("__i")) & (F.col("__version") == F.col("__v"))
    once = joined.join(several, same, "left_anti").select(*[docs[c] for c in docs.columns])
    again = joined.join(several, same, "left_semi").dropDuplicates(["__id", "__version"]).select(*[docs[c] for c in docs.columns])
    return once.union(again)


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
