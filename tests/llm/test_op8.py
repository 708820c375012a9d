"""SimHash near duplicates against brute force."""

import itertools
import random

import pytest
import xxhash

from geotally.llm import op8_simhash as op

SCHEMA = "doc_id long, text string"


def brute_fingerprint(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for blank in "\t\n\x0b\x0c\r":
        words = words.replace(blank, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, budget=3):
    parent = {fp: fp for fp in prints.values()}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(sorted(parent), 2):
        if (a ^ b).bit_count() <= budget:
            parent[root(b)] = root(a)
    low = {}
    for doc, fp in prints.items():
        low[root(fp)] = min(doc, low.get(root(fp), doc))
    return {doc: low[root(fp)] for doc, fp in prints.items()}


def rows(df):
    return {r["doc_id"]: (r["fp"] % (1 << 64), r["component_id"]) for r in df.collect()}


def test_fingerprint_matches_brute_force():
    rnd = random.Random(5)
    for _ in range(200):
        text = "".join(rnd.choice("aBé \n\t\x0b  zZ") for _ in range(rnd.randint(0, 60)))
        assert op.fingerprint(text.encode()) == brute_fingerprint(text)
    assert op.fingerprint(None) == op.fingerprint(b" \n") == 0
    long = " ".join(f"w{rnd.randrange(900)}" for _ in range(3 * op.SHINGLES + 7))
    assert op.fingerprint(long.encode()) == brute_fingerprint(long)


def near_copies(n, seed=1):
    rnd = random.Random(seed)
    words = ["".join(rnd.choice("abcdefgh") for _ in range(5)) for _ in range(400)]
    base = [rnd.choice(words) for _ in range(300)]
    out = []
    for _ in range(n):
        copy = list(base) if rnd.random() < 0.6 else [rnd.choice(words) for _ in range(rnd.randint(0, 40))]
        for _ in range(rnd.randint(0, 4)):
            if copy:
                copy[rnd.randrange(len(copy))] = rnd.choice(words)
        out.append(" ".join(copy))
    return out


@pytest.mark.parametrize("node_rows", [1024, 4])
def test_components_match_brute_force_with_and_without_splitting(spark, node_rows):
    texts = [*near_copies(260), "", None, " \n", "same text", "same text", "Same TEXT"]
    docs = list(enumerate(texts, start=10))
    found = rows(op.near_duplicates(spark.createDataFrame(docs, SCHEMA).repartition(5), node_rows=node_rows))
    prints = {d: brute_fingerprint(t) for d, t in docs}
    assert {d: fp for d, (fp, _) in found.items()} == prints
    assert {d: c for d, (_, c) in found.items()} == brute_components(prints)


def test_traversal_finds_every_pair_within_the_budget():
    import numpy as np

    rnd = random.Random(3)
    seeds = [rnd.getrandbits(64) for _ in range(30)]
    values = sorted({s ^ sum(1 << rnd.randrange(64) for _ in range(rnd.randint(0, 4))) for s in seeds for _ in range(12)} | {0, (1 << 64) - 1})
    array = np.array(values, np.uint64)
    n = len(array)
    a, b = op.traverse(array, [np.array([x]) for x in (0, n, 0, n, 0)], 0, 3)
    assert {tuple(sorted(p)) for p in zip(a.tolist(), b.tolist(), strict=True)} == {
        (i, j) for i, j in itertools.combinations(range(n), 2) if (values[i] ^ values[j]).bit_count() <= 3}


def test_empty_table_repeated_rows_and_clashing_columns(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert op.near_duplicates(empty).count() == 0
    docs = spark.createDataFrame([(1, "a b c", 7, "x"), (1, "a b c", 7, "x"), (None, "a b c", 8, "y"), (2, "q r s t", 9, "z")], "doc_id long, text string, fp long, component_id string")
    found = sorted((r["doc_id"] or 0, r["component_id"]) for r in op.near_duplicates(docs).collect())
    assert found == [(0, 1), (1, 1), (1, 1), (2, 2)]
    kept = op.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 2]


def test_one_row_of_each_component_stays_with_null_and_repeated_ids(spark):
    text = lambda x: " ".join(f"{x}{i}" for i in range(40))
    rows = [(None, text("a")), (None, text("b")), (None, text("b")), (1, text("c")), (1, text("d")), (2, text("d")), (0, text("e")), (1, text("e")), (3, text("f")), (None, text("f")), (None, text("c"))]
    kept = op.keep_one(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()
    expected = [(None, "a"), (None, "b"), (1, "c"), (1, "d"), (0, "e"), (3, "f")]
    assert sorted((str(r.doc_id), r.text) for r in kept) == sorted((str(i), text(x)) for i, x in expected)
