"""Top-k search against brute force."""

import random

import pytest
from pyspark.sql import functions as F

from geotally.llm import op13_threshold as op

SCHEMA = "vec_id long, embedding array<float>"


def integers(vector):
    import math

    return [math.floor(x) * 1024 if abs(x) >= 2**53 else math.floor(x * 1024) for x in vector]


def brute(rows, k=10, every=100):
    import math

    rows = [(i, integers(v)) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = {}
    for q, v in rows:
        if q % every == 0:
            near = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), i) for i, w in rows if i != q and len(w) == len(v))
            out[q] = [(rank, i, -s) for rank, (s, i) in enumerate(near[:k], 1)]
    return {q: x for q, x in out.items() if x}


def found(df):
    out = {}
    for r in df.collect():
        out.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    return {q: sorted(x) for q, x in out.items()}


def asked(every=100):
    return F.pmod(F.col("vec_id"), F.lit(every)) == 0


def clustered(n, width, seed=3):
    rnd = random.Random(seed)
    centres = [[rnd.gauss(0, 0.1) for _ in range(width)] for _ in range(5)]
    return [(i, [float(f"{c + rnd.gauss(0, 0.04):.3f}") for c in rnd.choice(centres)]) for i in range(n)]


@pytest.mark.parametrize("shard,block", [(1 << 21, 1 << 21), (8 * 50, 8 * 10)])
def test_matches_brute_force_for_any_shards_and_query_blocks(spark, monkeypatch, shard, block):
    monkeypatch.setattr(op, "SHARD_VALUES", shard)
    rows = clustered(700, 8)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    assert found(op.top_k(df, asked(20), query_values=block)) == brute(rows, every=20)


def test_ties_repeated_rows_and_a_vector_that_most_rows_share(spark):
    rnd = random.Random(4)
    common = [0.5, -0.25, 0.125]
    rows = [(i, common if rnd.random() < 0.6 else [rnd.choice([-0.5, 0.0, 0.5]) for _ in range(3)]) for i in range(400)]
    rows += [(7, rows[7][1]), (7, rows[7][1]), (200, rows[200][1]), (300, [0.0, 0.0, 0.0])]
    df = spark.createDataFrame(rows[:-1], SCHEMA).repartition(4)
    expected = brute(rows[:-1])
    assert found(op.top_k(df, asked())) == {q: x for q, x in expected.items()}


def test_zero_queries_nulls_lengths_and_huge_components(spark):
    rows = [(0, [0.0, 0.0]), (100, [1e30, -1e30]), (1, [1e30, 1.0]), (2, [-1e30, 3.0]), (3, [float("nan"), 1.0]), (4, [float("inf"), 1.0]),
            (5, [None, 1.0]), (6, None), (None, [1.0, 1.0]), (7, [1.0]), (200, [2.0]), (8, [3.0]), (300, []), (9, []), (10, []), (11, [0.5, 0.25]), (-100, [0.25, -0.5])]
    got = found(op.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), asked()))
    clip = lambda s: max(-(1 << 63), min((1 << 63) - 1, s))
    assert got == {q: [(r, i, clip(s)) for r, i, s in x] for q, x in brute(rows).items()}


def test_few_rows_empty_table_and_clashing_columns(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert op.top_k(empty, asked()).count() == 0
    assert op.top_k(spark.createDataFrame([(1, [1.0]), (2, [1.0])], SCHEMA), asked()).count() == 0
    df = spark.createDataFrame([(0, [1.0], 5, "x", 2), (1, [2.0], 6, "y", 3)], SCHEMA + ", rank int, score string, at int")
    assert found(op.top_k(df, asked())) == {0: [(1, 1, 1024 * 2048)]}


def test_query_leaves_the_shard_early():
    import numpy as np

    rnd = np.random.default_rng(1)
    matrix = rnd.normal(0, 0.02, (20_000, 6))
    matrix[:50, 0] += 1
    shard = op.Shard(np.arange(20_000), matrix, 10)
    counted = []

    class Counting(np.ndarray):
        def __getitem__(self, key):
            if isinstance(key, np.ndarray) and key.ndim == 1:
                counted.append(len(key))
            return super().__getitem__(key)

    shard.matrix = shard.matrix.view(Counting)
    query = np.array([1024.0, 0, 0, 0, 0, 3])
    best = shard.search(-1, query, [])
    exact = np.asarray(shard.matrix) @ query
    assert [-s for s, _ in best] == sorted(exact.astype(int).tolist(), reverse=True)[:10]
    assert sum(counted) < 2000
