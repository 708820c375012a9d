"""Merkle manifest against a plain version; the block layout against its definition."""

import zlib
from hashlib import sha256

import numpy as np
import pytest

from geotally.llm import op12_merkle as op

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def h(text):
    return sha256(text.encode()).hexdigest()


def leaf_of(row, text=None):
    doc, own, lang, source, n = row
    values = (doc, source, lang, n, own if text is None else text)
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def climb(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([h("".join(levels[-1][i : i + 16])) for i in range(0, len(levels[-1]), 16)])
    return levels


def way(levels, index):
    out = []
    for level in levels[:-1]:
        run = level[index // 16 * 16 : index // 16 * 16 + 16]
        out.append(("".join(run[: index % 16]), "".join(run[index % 16 + 1 :])))
        index //= 16
    return out


def brute(rows):
    sources = sorted({r[3] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: sorted((r for r in rows if r[3] == s), key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r))) for s in sources}
    levels = {s: climb([leaf_of(r) for r in trees[s]]) for s in sources}
    over = climb([levels[s][-1][0] for s in sources])
    out = []
    for at, s in enumerate(sources):
        for i, r in enumerate(trees[s]):
            path = way(levels[s], i) + way(over, at)
            cur = leaf_of(r)
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0 and r[1] is not None:
                cur = leaf_of(r, "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in r[1]))
            for before, after in path:
                cur = h(before + cur + after)
            root = over[-1][0]
            out.append((r[0], leaf_of(r), levels[s][-1][0], root, h("".join(a + b for a, b in path)), cur, cur == root))
    return sorted(out, key=str)


def query(spark, rows, tmp_path, schema=SCHEMA):
    folder = str(tmp_path / "t")
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(f"{folder}/documents.parquet")
    df = op.op12_merkle(spark, folder)
    assert df.columns == op.PROOF_NAMES
    return sorted((tuple(r) for r in df.collect()), key=str)


def many(n, sources, **more):
    return [(i, f"Text Nº {i}" if i % 3 else f"plain {i}", "en", sources(i), i * 7) for i in range(n)]


def test_matches_brute_force(spark, tmp_path):
    rows = many(700, lambda i: "hot" if i % 3 else f"s{i % 40:02d}")
    rows += [(900, None, None, None, None), (901, "", "", "", 0), (902, "É\U0001F600 A", "fr", "ünï", 2), (903, "Long " * 40_000, "en", "s01", 1)]
    assert query(spark, rows, tmp_path) == brute(rows)


@pytest.mark.parametrize("levels", [2, 3])
def test_several_rounds_of_blocks(spark, tmp_path, monkeypatch, levels):
    monkeypatch.setattr(op, "LEVELS", levels)
    monkeypatch.setattr(op, "WIDTH", 16 ** (levels - 1))
    rows = many(1100, lambda i: "a" if i < 600 else "b" if i < 617 else "c" if i < 873 else f"x{i}")  # over 200 sources
    assert query(spark, rows, tmp_path) == brute(rows)


def test_null_and_repeated_ids_and_equal_rows(spark, tmp_path):
    rows = many(40, lambda i: "a") + [(None, "B", "en", "a", 1)] * 20 + [(5, "Other", "de", "a", 2)] + [(7, "Same Row", "en", "b", 3)] * 30
    assert query(spark, rows, tmp_path) == brute(rows)


def test_one_row_empty_table_and_clashing_columns(spark, tmp_path):
    one = [(15, "Lone", "en", "a", 4)]
    found = query(spark, one, tmp_path / "one")
    assert found == brute(one) and found[0][1] == found[0][2] == found[0][3]
    empty = spark.createDataFrame([], SCHEMA)
    assert op.proofs(op.build(empty)).collect() == [] and op.build(empty).root is None
    extra = [(*r, "x", 3, b"y") for r in many(50, lambda i: f"s{i % 3}")]
    assert query(spark, extra, tmp_path / "extra", SCHEMA + ", tree string, idx int, leaf binary") == brute([r[:5] for r in extra])


def test_a_change_is_found_in_its_row_alone(spark, tmp_path):
    rows = many(300, lambda i: f"s{i % 2}")
    found = query(spark, rows, tmp_path)
    changed = {r[0] for r in rows if zlib.crc32(str(r[0]).encode()) % 5 == 0 and r[1] != r[1].lower()}
    assert {r[0] for r in found if not r[6]} == changed


@pytest.mark.parametrize("leaves", [1, 2, 16, 17, 255, 256, 257, 1000, 4095, 4096])
@pytest.mark.parametrize("lone", [True, False])
def test_addresses_are_the_van_emde_boas_order(leaves, lone):
    sizes = op.level_sizes(leaves, lone)

    def order(level, index, height):
        """Nodes of a subtree, by the layout's definition."""
        if index >= sizes[level]:
            return []
        if height == 1:
            return [(level, index)]
        upper = height // 2
        below = range(index * 16**upper, (index + 1) * 16**upper)
        return order(level, index, upper) + [n for i in below for n in order(level + upper, i, height - upper)]

    places = {n: p for p, n in enumerate(order(0, 0, len(sizes)))}
    assert len(places) == sum(sizes)
    for level, size in enumerate(sizes):
        assert op.address(sizes, level, np.arange(size)).tolist() == [places[level, i] for i in range(size)]
