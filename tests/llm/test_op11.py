"""Collocations against brute force."""

import random
import re
from collections import Counter

import pytest

from geotally.llm import op11_setm as op

SCHEMA = "doc_id long, text string, lang string"


def brute(rows, max_words=3, least=10, top=2000, share=50):
    f, n = Counter(), Counter()
    for _, text, lang in rows:
        lang = lang or "und" if lang is None else lang
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", low):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, max_words + 1):
                for i in range(len(words) - k + 1):
                    f[lang, tuple(words[i : i + k])] += 1
    candidates = {p: a for p, a in f.items() if len(p[1]) > 1 and a >= least}
    dropped = set()
    for (lang, words), a in candidates.items():
        for k in range(2, len(words)):
            for i in range(len(words) - k + 1):
                part = (lang, words[i : i + k])
                if 100 * a >= share * candidates[part]:
                    dropped.add(part)
    out = []
    for lang in {lang for lang, _ in candidates}:
        rows = []
        for (own, words), a in candidates.items():
            if own == lang and (own, words) not in dropped:
                cuts = [(1_000_000 * a * a // (f[lang, words[:k]] * f[lang, words[k:]]), k) for k in range(1, len(words))]
                score, k = min(cuts)
                rows.append((-score, -a, " ".join(words).encode(), f[lang, words[:k]], f[lang, words[k:]]))
        out += [(lang, rank, p.decode(), -a, left, right, n[lang], -s) for rank, (s, a, p, left, right) in enumerate(sorted(rows)[:top], 1)]
    return sorted(out)


def texts(n, seed=2):
    rnd = random.Random(seed)
    words = ["the", "The", "of", "new", "york", "city", "état", "zażółć", "a", "'s", "\U0001F600", "x-y"]
    out = []
    for i in range(n):
        parts = [rnd.choice(["new york city", "New\tYork  state", " ".join(rnd.choices(words, k=rnd.randint(1, 9))), "the the the the"]) for _ in range(rnd.randint(0, 8))]
        out.append((i, "".join(p + rnd.choice([". ", ",", "\n", " ", "\x0b", "!?"]) for p in parts), rnd.choice(["en", "en", "de", None, "und", ""])))
    return out


def found(df):
    assert df.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("block", [op.BLOCK, 50])
@pytest.mark.parametrize("max_words", [2, 3, 5])
def test_matches_brute_force(spark, monkeypatch, block, max_words):
    monkeypatch.setattr(op, "BLOCK", block)
    monkeypatch.setattr(op, "CHUNK", 7 if block == 50 else 64)
    monkeypatch.setattr(op, "ROWS", 5 if block == 50 else 1 << 16)
    rows = texts(160)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert found(op.collocations(df, max_words)) == brute(rows, max_words)


def test_top_ties_and_repeated_rows(spark):
    rows = texts(120, seed=9) + [(1, "b c. a b. c a", "en")] * 40 + [(None, "same pair", "en")] * 12
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    assert found(op.collocations(df, top=5, least=12)) == brute(rows, top=5, least=12)


def test_very_long_words_texts_and_pieces(spark):
    long = "w" * 70_000
    rows = [(0, " ".join(["p q"] * 150_000), "en"), (1, (long + " z. ") * 11, "en"), (2, ".,;:!?\n" * 1000, "en")]
    assert found(op.collocations(spark.createDataFrame(rows, SCHEMA))) == brute(rows)


def test_nulls_empty_table_and_clashing_columns(spark):
    assert found(op.collocations(spark.createDataFrame([], SCHEMA))) == []
    rows = [(1, None, "en"), (2, "", None), (3, "only one", "en")]
    assert found(op.collocations(spark.createDataFrame(rows, SCHEMA))) == []
    rows = [(i, "a b c", None) for i in range(15)]
    extra = [(*r, 1, "x", 2.0, b"z") for r in rows]
    assert found(op.collocations(spark.createDataFrame(extra, SCHEMA + ", block int, word string, n double, number binary"))) == brute(rows)


def test_scores_of_large_counts_are_exact(spark):
    row = spark.range(1).selectExpr("cast(99999999999977 as decimal(14,0)) a", "cast(99999999999989 as decimal(14,0)) l", "cast(99999999999999 as decimal(14,0)) r")
    got = row.selectExpr("(1000000BD * (a * a)) div (l * r) AS s").first().s
    assert got == 1_000_000 * 99999999999977**2 // (99999999999989 * 99999999999999)
