"""Exact top-k search by Fagin's threshold algorithm over sorted per-dimension lists.

Components become integers, floor(``SCALE`` * x); a score is the inner product of two integer vectors.

Candidates are taken in shards of bounded size where they are scanned, so no vector is ever shuffled. A shard keeps, for each
dimension, the list of its vectors sorted by that component. A query reads all lists in parallel, from the end that its own
component's sign prefers, in growing steps of depth; each vector met for the first time is scored at once by random access. No
vector that is still unseen can score more than the sum over the lists of the query's component times the next component
of the list. When this bound is below the k-th best score, the query leaves the shard. The k best of the shards before go along, so
later shards of a task are left earlier. Equal vectors of a shard stand in its lists once, with their smallest ids: a vector that very
many rows share is neither scored nor met again. Each task returns k rows a query, which meet in one ranking window.

Queries are a stated set. They are dealt into blocks of at most ``QUERY_VALUES`` components by their hash; one job per block
broadcasts that block (a proven bound, whatever the number of queries) and reads all candidates.

Defined results: a vector that is null or holds a null or non-finite component takes no part, nor does a row without an id; vectors of
different length are not compared; a query whose components are all zero scores zero with all; vectors of no components score zero with
each other. Repeated rows are candidates each; equal query rows are one query; rows of the query's own id are no candidates. Ties go to the
smaller id. Scores are exact (beyond 2^53 in Python's integers); one beyond a long is shown as the long nearest to it. An empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import table, written

K, SCALE, EVERY = 10, 1024, 100
#: Components of a shard's vectors (64 dimensions: 32,768 vectors), and of a block of queries.
SHARD_VALUES, QUERY_VALUES = 1 << 21, 1 << 21
#: Depth of the first step of sorted access, and the growth of the steps after it.
FIRST_STEP, GROWTH = 16, 1.5
EXACT, LONGEST = 1 << 53, (1 << 63) - 1


def scaled(values: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """floor(scale * x), exact: as doubles that hold integers, or as Python's integers where a double can't."""
    with np.errstate(over="ignore"):
        found = np.floor(values * scale)
    if np.abs(found).max(initial=0) < EXACT:
        return found + 0.0
    return np.array([math.floor(x) * scale if abs(x) >= EXACT else math.floor(x * scale) for x in values.ravel().tolist()], object).reshape(values.shape)


def parsed(ids: pa.Array, vectors: pa.Array) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Ids and vectors (a row each) by the vectors' length; what takes no part is left out."""
    lists = vectors.cast(pa.list_(pa.float64()))
    sizes = np.diff(lists.offsets.to_numpy())
    starts = lists.offsets.to_numpy()[:-1]
    flat = lists.values.to_numpy(zero_copy_only=False) if len(lists.values) else np.zeros(0)  # nulls become NaN
    known = ~(lists.is_null().to_numpy(zero_copy_only=False) | ids.is_null().to_numpy(zero_copy_only=False))
    own = ids.fill_null(0).to_numpy(zero_copy_only=False)
    out = {}
    for width in np.unique(sizes[known]).tolist():
        rows = np.nonzero(known & (sizes == width))[0]
        matrix = flat[starts[rows][:, None] + np.arange(width)] if width else np.zeros((len(rows), 0))
        fine = np.isfinite(matrix).all(1)
        if fine.any():
            out[width] = (own[rows[fine]], matrix[fine])
    return out


class Shard:
    """Vectors of one length, each once, and their sorted list for each dimension."""

    def __init__(self, ids: np.ndarray, matrix: np.ndarray, k: int, scale: int = SCALE):
        matrix = matrix + 0.0  # no negative zero, so that equal vectors have equal bytes
        if matrix.shape[1]:
            rows = np.ascontiguousarray(matrix).view(np.dtype((np.void, matrix.shape[1] * 8))).ravel()
            _, first, of = np.unique(rows, return_index=True, return_inverse=True)
        else:
            first, of = np.zeros(1, np.int64), np.zeros(len(ids), np.int64)
        self.matrix = scaled(matrix[first], scale)
        order = np.lexsort((ids, of))
        self.ids = ids[order]
        self.cuts = np.concatenate(([0], np.cumsum(np.bincount(of, minlength=len(first)))))
        self.k, self.n = k, len(first)
        self.lists = np.argsort(-self.matrix, axis=0, kind="stable").T.astype(np.int32)  # largest component first
        self.size = int(np.abs(self.matrix).max(initial=0))

    def rows_of(self, vectors: np.ndarray, query: int) -> list[tuple[int, int]]:
        """(place in ``vectors``, id) of the k smallest ids of each vector, without the query's."""
        out = []
        for place, v in enumerate(vectors.tolist()):
            own, taken = self.ids[self.cuts[v] : self.cuts[v + 1]], 0
            for i in own.tolist() if len(own) <= self.k else self._least(own, query):
                if i != query:
                    out.append((place, i))
                    taken += 1
                    if taken == self.k:
                        break
        return out

    def _least(self, own: np.ndarray, query: int) -> list[int]:
        a, b = np.searchsorted(own, [query, query + 1])  # sorted ids; those of the query lie together
        return [*own[: min(a, self.k)].tolist(), *own[b : b + self.k].tolist()]

    def search(self, query: int, vector: np.ndarray, best: list[tuple[int, int]]) -> list[tuple[int, int]]:
        """The k best (-score, id) of ``best`` and of this shard, sorted."""
        k = self.k
        big = max(1, len(vector)) * self.size * max(1, int(np.abs(vector).max(initial=0))) >= EXACT
        vector = np.array([int(x) for x in vector], object) if big else vector.astype(float)
        matrix = self.matrix
        if big and matrix.dtype != object:
            matrix = np.array([[int(x) for x in row] for row in matrix.tolist()], object).reshape(matrix.shape)
        dims = np.nonzero(vector)[0]
        weights, down = vector[dims], vector[dims] > 0
        seen = np.zeros(self.n, bool)
        depth, step = 0, FIRST_STEP
        while True:
            to = min(self.n, depth + step) if len(dims) else self.n
            if len(dims):
                met = np.zeros(self.n, bool)
                met[self.lists[dims[down], depth:to]] = True
                met[self.lists[dims[~down], self.n - to : self.n - depth]] = True
                fresh = np.nonzero(met & ~seen)[0]
                seen[fresh] = True
            else:
                fresh = np.arange(self.n)
            if len(fresh):
                scores = matrix[fresh] @ vector if len(vector) else np.zeros(len(fresh))
                if len(best) == k:
                    least = -best[-1][0]
                    near = np.nonzero(scores >= least)[0]
                else:
                    near = np.arange(len(fresh))
                if len(near) > 4 * k:  # the k best vectors, and all that tie with the last of them
                    cut = np.sort(scores[near])[-k - 1] if not big else sorted(scores[near].tolist())[-k - 1]
                    near = near[scores[near] >= cut]
                if len(near):
                    best = sorted([*best, *((-int(scores[near[p]]), i) for p, i in self.rows_of(fresh[near], query))])[:k]
            depth, step = to, math.ceil(step * GROWTH)
            if depth >= self.n:
                return best
            if len(best) == k:
                ends = np.where(down, self.lists[dims, depth], self.lists[dims, self.n - 1 - depth])
                if (weights * matrix[ends, dims]).sum() < -best[-1][0]:
                    return best


def searcher(block, k: int, scale: int):
    """Batches (id, vector) of candidates to the k best of them for each query of the block."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[tuple[int, int], list[tuple[int, int]]] = {}
        held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        sizes: dict[int, int] = {}

        def flush(width: int) -> None:
            ids, matrix = (np.concatenate(x) for x in zip(*held.pop(width), strict=True))
            sizes.pop(width)
            queries, vectors = block.value.get(width, ((), ()))
            shard = Shard(ids, matrix, k, scale) if len(queries) else None
            for at, (query, vector) in enumerate(zip(queries, vectors, strict=True)):
                best[width, at] = shard.search(int(query), vector, best.get((width, at), []))

        for batch in batches:
            for width, (ids, matrix) in parsed(batch.column(0), batch.column(1)).items():
                step = max(1, SHARD_VALUES // max(width, 1))
                for at in range(0, len(ids), step):
                    part = ids[at : at + step], matrix[at : at + step]
                    if sizes.get(width, 0) + len(part[0]) > step:
                        flush(width)
                    held.setdefault(width, []).append(part)
                    sizes[width] = sizes.get(width, 0) + len(part[0])
        for width in list(held):
            flush(width)
        shown = lambda s: max(-LONGEST - 1, min(LONGEST, s))
        rows = [(int(block.value[w][0][at]), at, w, i, shown(-s), str(-s) if shown(-s) != -s else None) for (w, at), found in best.items() for s, i in found]
        for at in range(0, len(rows), 65536):
            columns = zip(*rows[at : at + 65536], strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.string()), strict=True)], names=["query_id", "at", "width", "vec_id", "score", "exact"])
    return run


def _block(queries: DataFrame, scale: int) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Ids and integer vectors by length of one block of queries, whose size the caller has bounded."""
    rows = queries.toArrow().combine_chunks()
    if not rows.num_rows:
        return {}
    found = parsed(rows.column(0).combine_chunks(), rows.column(1).combine_chunks())
    return {w: (ids, scaled(matrix, scale)) for w, (ids, matrix) in found.items()}


def top_k(vectors: DataFrame, is_query: Column, k: int = K, id_column: str = "vec_id", vector_column: str = "embedding", scale: int = SCALE, query_values: int = QUERY_VALUES) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` candidates of largest inner product for each row that ``is_query`` picks."""
    spark = vectors.sparkSession
    source = vectors.select(F.col(id_column).cast("long").alias("vec_id"), F.col(vector_column).cast("array<double>").alias("vector"), F.coalesce(is_query, F.lit(False)).alias("asked"))
    usable = F.col("vec_id").isNotNull() & F.col("vector").isNotNull()
    queries = written(source.where(F.col("asked") & usable).select("vec_id", "vector").distinct(), "queries")
    count, width = queries.agg(F.count("*"), F.max(F.size("vector"))).first()
    # Twice as many blocks as needed, so that chance leaves none beyond its bound by much.
    blocks = math.ceil(2 * count * max(width or 1, 1) / query_values) if count * max(width or 1, 1) > query_values else 1
    place = F.pmod(F.xxhash64("vec_id", "vector"), F.lit(blocks))
    candidates = source.where(usable).select("vec_id", "vector")
    # Scores beyond a long also carry their digits: more digits are more above zero, and less below.
    digits = F.when(F.col("score") > 0, F.length("exact")).otherwise(-F.length("exact"))
    order = Window.partitionBy("query_id", "at", "width").orderBy(
        F.desc("score"), F.desc(digits), F.desc(F.when(F.col("score") > 0, F.col("exact"))), F.asc("exact"), F.asc("vec_id"))
    found = None
    for number in range(blocks):
        block = spark.sparkContext.broadcast(_block(queries.where(place == number), scale))
        near = candidates.mapInArrow(searcher(block, k, scale), "query_id long, at int, width int, vec_id long, score long, exact string")
        ranked = near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
        if blocks > 1:
            ranked = written(ranked, "nearest")
        found = ranked if found is None else found.union(ranked)
    return found


def op13_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), F.pmod(F.col("vec_id"), F.lit(EVERY)) == 0)


SQL = f"""
WITH usable AS (
  SELECT vec_id, [CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
),
parts AS (SELECT vec_id, unnest(v) AS x, unnest(range(len(v))) AS d FROM usable),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(sum(q.x * c.x) AS BIGINT) AS score
  FROM parts q JOIN parts c ON q.d = c.d AND q.vec_id <> c.vec_id
  WHERE q.vec_id % {EVERY} = 0
  GROUP BY q.vec_id, c.vec_id
),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= {K}
"""
