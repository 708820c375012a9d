"""The Bloom filter of words: what it lets pass, where it stands, and what is shuffled because of it."""

import random

import pytest

from geotally.operators import bayes, bloom
from helpers import message, messages_df
from pyspark.sql import functions as F


def words_df(spark, words):
    return spark.createDataFrame([(w,) for w in words], "word string")


def passing(spark, listed, asked, **sizes):
    df = words_df(spark, asked)
    return [r.word for r in df.where(bloom.might_hold(bloom.word_filter(words_df(spark, listed), **sizes), F.col("word"))).collect()]


def test_every_listed_word_passes_and_few_others(spark):
    rnd = random.Random(6)
    words = ["".join(rnd.choice("abcdé\U0001F600 ") for _ in range(12)) for _ in range(6000)]
    listed, others = set(words[:3000]) | {""}, set(words[3000:])
    found = passing(spark, [*listed, *list(listed)[:50]], [*listed, *(others - listed)])
    assert listed <= set(found)
    assert len(found) - len(listed) < 0.02 * len(others)


def test_no_words_let_nothing_pass_and_nulls_are_no_words(spark):
    assert passing(spark, [], ["a", "", "b"]) == []
    assert passing(spark, [None], ["a", ""]) == []


def test_a_filter_that_is_too_small_passes_more_but_changes_no_count(spark, monkeypatch):
    rows = [message(f"a{i} b{i % 7} common", place=f"p{i % 3}") for i in range(400)]
    m, vocab = messages_df(spark, rows), words_df(spark, ["common", "b3", "a17", "none"])
    exact = {(r.place_name, r.word): r.n for r in bayes.place_counts(m).collect() if r.word in (None, "common", "b3", "a17")}
    for largest in (64, 1 << 20):
        monkeypatch.setattr(bloom.word_filter, "__defaults__", (None, bloom.BITS_PER_WORD, largest))
        assert {(r.place_name, r.word): r.n for r in bayes.place_counts(m, vocab).collect()} == exact


def test_only_votes_for_the_listed_words_reach_the_exchange(spark):
    rnd = random.Random(2)
    texts = [" ".join(f"w{rnd.randrange(20_000)}" for _ in range(60)) for _ in range(500)]
    m = messages_df(spark, [message(t) for t in texts])
    vocab = words_df(spark, [f"w{i}" for i in range(200)])
    wanted = sum(len({w for w in t.split(" ") if int(w[1:]) < 200}) for t in texts)
    everything = sum(len(set(t.split(" "))) for t in texts)
    rows = bayes.votes(m, vocab).where("word IS NOT NULL").count()
    assert wanted <= rows < wanted + 0.02 * everything
    plan = bayes.place_counts(m, vocab)._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("partial_count"):]
    assert "getbit" in below or "bit_get" in below  # printed below = before the counts and their exchange
    assert "Join" not in below.split("Subquery")[0].split("Generate explode")[0]


@pytest.mark.parametrize("words", [1, 40])
def test_prediction_with_a_batch_model_equals_the_full_model(spark, words):
    rnd = random.Random(words)
    rows = [message(" ".join(f"w{rnd.randrange(30)}" for _ in range(12)), place=f"p{rnd.randrange(4)}") for _ in range(200)]
    m = messages_df(spark, rows)
    inputs = spark.createDataFrame([(i, " ".join(f"W{rnd.randrange(30)}" for _ in range(words))) for i in range(20)], "input_id long, text string")
    batch = bayes.prepare_inputs(inputs)
    one = bayes.predict_place(bayes.fit_and_write_place_model(m, batch.vocabulary()), batch)
    full = bayes.predict_place(bayes.fit_place_model(m), inputs)
    key = lambda r: (r[0], str(r[1]))
    assert sorted(map(tuple, one.collect()), key=key) == sorted(map(tuple, full.collect()), key=key)
