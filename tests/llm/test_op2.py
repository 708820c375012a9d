"""Base scores against brute force; the class model's probabilities sum to one and beat the base on structured text."""

import math
import random
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from geotally.llm import op2_brown as op

SCHEMA = "doc_id long, text string, score string"


def tokens(text):
    return [*(text or "").encode().lower().split(), None]


def held(doc):
    return doc is not None and zlib.crc32(str(doc).encode()) % 7 == 2


def corpus(n=120):
    rnd = random.Random(2)
    languages = [["le", "la", "Une", "maison", "chat", "est"], ["der", "die", "Das", "haus", "ist", "und"]]
    rows = []
    for i in range(n):
        own = languages[i % 2]
        rows.append((i, " ".join(rnd.choice(own) if rnd.random() < 0.9 else f"w{rnd.randint(0, 500)}" for _ in range(rnd.randint(0, 60))), "x"))
    return rows + [(500, None, "x"), (501, "", "x"), (502, " \n", "x"), (3, "repeated id", "y"), (None, "no id", "z")]


@pytest.fixture(scope="module")
def scored(spark):
    rows = corpus()
    return rows, op.score(spark.createDataFrame(rows, SCHEMA).repartition(4), lexicon_size=8, rounds=2).collect()


def test_base_matches_brute_force(scored):
    rows, got = scored
    counts = Counter(t for d, text, _ in rows if not held(d) for t in tokens(text))
    n, v = sum(counts.values()), len(counts)
    expected = sorted((str(d), held(d), len(tokens(t)), sum(counts[x] > 0 for x in tokens(t)), n,
                       round(sum(math.log10((counts[x] + 1) / (n + v + 1)) for x in tokens(t)), 6)) for d, t, _ in rows)
    assert sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == expected


def test_classes_beat_the_base_on_held_out_texts(scored):
    _, got = scored
    own = [r for r in got if r.held_out]
    assert own and sum(r.score for r in own) > sum(r.base_score for r in own)
    assert all(r.score < 0 for r in got)


def test_exchange_raises_the_likelihood_and_model_sums_to_one():
    rnd = np.random.default_rng(3)
    units, width = op.UNITS, 2 * (op.CLASSES + 1) + 1
    sequence = np.concatenate([rnd.choice([k, k + 2, k + 4], 40) for k in rnd.integers(0, 2, 200)])
    classes = op.first_classes()
    classes[: 6] = [0, 0, 0, 1, 1, 1]

    def profile(classes):
        out = np.zeros((units, width), np.int64)
        a, b = sequence[:-1], sequence[1:]
        np.add.at(out, (a, classes[b]), 1)
        np.add.at(out, (b, op.CLASSES + 1 + classes[a]), 1)
        np.add.at(out, (a[a == b], width - 1), 1)
        return out

    start = profile(classes)
    better = op.exchange(start, classes)
    assert op.likelihood(op._bigrams(profile(better), better)) > op.likelihood(op._bigrams(start, classes))
    bigrams = op._bigrams(start, classes)
    frequency = (bigrams.sum(0) + 1) / (bigrams.sum() + op.CLASSES + 1)
    step = (bigrams + op.PRIOR * frequency) / (bigrams.sum(1, keepdims=True) + op.PRIOR)
    assert np.allclose(step.sum(1), 1)


def test_no_training_text_and_empty_table(spark):
    one = next(i for i in range(100) if held(i))
    got = op.score(spark.createDataFrame([(one, "a b", "x")], SCHEMA), rounds=1).collect()
    assert [(r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in got] == [(3, 0, 0, 0.0)]
    assert op.score(spark.createDataFrame([], SCHEMA), rounds=1).count() == 0


def test_lexicon_holds_all_words_above_a_limit(spark):
    rnd = random.Random(4)
    rows = [(f"w{i}".encode(), rnd.randint(1, 1000)) for i in range(400)]
    counts = spark.createDataFrame(rows, "word binary, n long")
    for size in (0, 1, 30, 399, 400, 1000):
        words, numbers = op._commonest(counts, size)
        assert len(words) <= size and list(numbers) == sorted(numbers, reverse=True)
        left = [n for w, n in rows if w not in set(words)]
        assert not words or not left or min(numbers) > max(left)
        assert size < 30 or len(words) >= min(size, 400) * 0.7


def test_a_large_batch_of_texts_is_scored_in_parts():
    rnd = np.random.default_rng(5)
    words = [b"w%d" % i for i in range(50)]
    lexicon = op.Lexicon({w: i for i, w in enumerate(words)}, rnd.integers(1, 90, 50).astype(float), 2000, 50, 40)
    model = op.Model(op.first_classes(), np.log10(rnd.random((op.CLASSES + 1, op.CLASSES + 1))), np.ones(op.CLASSES + 1))
    sizes = np.concatenate(([0, 2 * op.PART_TOKENS, 0], rnd.integers(0, 1400, 6000), [0]))
    ids = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(sizes))), pa.int32()), pa.array(rnd.integers(0, 50, sizes.sum()).astype(np.int32)))
    rows = pa.array(np.arange(len(sizes)))
    batch = pa.RecordBatch.from_arrays([rows, rows, pa.array([False] * len(sizes)), ids], names=["row", "doc_id", "held", "ids"])
    tracemalloc.start()
    found = pa.Table.from_batches(op.scores(iter([batch]), lexicon, model))
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 100 * 2 * op.PART_TOKENS
    assert found["row"].to_pylist() == rows.to_pylist() and found["n_tokens"].to_pylist() == (sizes + 1).tolist()
    # One text at a time is what any parts must give.
    each = pa.Table.from_batches(b for i in range(2, len(sizes), 500) for b in op.scores(iter([batch.slice(i, 1)]), lexicon, model))
    assert np.allclose(found["score"].to_numpy()[2::500], each["score"].to_numpy())
