"""Place predictor: golden values, tie and zero rules, one vote per message, long inputs."""

import pytest

from helpers import message, messages_df
from geotally.operators import bayes


def predict(spark, model, texts, **kw):
    inputs = spark.createDataFrame(list(enumerate(texts)), "input_id long, text string")
    rows = bayes.predict_place(model, inputs, **kw).collect()
    out = {}
    for r in rows:
        out.setdefault(r.input_id, []).append((r.place_name, r.prob))
    return [sorted(out[i], key=lambda x: (x[0] is None, x[0])) for i in range(len(texts))]


@pytest.fixture(scope="module")
def model(golden_messages):
    return bayes.fit_place_model(golden_messages)


# The golden inputs and their expected (place, probability), exact doubles.
GOLDEN = [
    ("state", "NewYork", 0.6),
    ("state building", "NewYork", 0.19999999999999998),
    ("state building building building", "London", 0.025),
    ("empire building", "NewYork", 0.13333333333333333),
]


def test_golden_values_bit_exact(spark, model):
    got = predict(spark, model, [t for t, _, _ in GOLDEN])
    for (text, place, prob), rows in zip(GOLDEN, got):
        assert rows == [(place, prob)], text


def test_unknown_word_is_blank(spark, model):
    assert predict(spark, model, ["hello"]) == [[(None, None)]]


def test_every_candidate_zero_is_blank(spark, model):
    # 'state' is everywhere, 'hello' nowhere: every place scores 0.
    assert predict(spark, model, ["state hello"]) == [[(None, None)]]


def test_single_candidate(spark, model):
    # Only London has 'ben': 2/5 * 1/2.
    assert predict(spark, model, ["ben"]) == [[("London", 0.2)]]


def test_input_is_lowercased(spark, model):
    assert predict(spark, model, ["STATE"]) == [[("NewYork", 0.6)]]


def test_several_inputs_scored_in_one_job(spark, model):
    got = predict(spark, model, [t for t, _, _ in GOLDEN] + ["hello", "ben"])
    assert [r[0][0] for r in got] == ["NewYork", "NewYork", "London", "NewYork", None, "London"]


def test_same_word_twice_in_message_votes_once(spark):
    m = messages_df(spark, [message("rain rain rain", place="A"), message("sun", place="A"),
                            message("rain", place="B")])
    model = bayes.fit_place_model(m)
    terms = {(r.place_name, r.word): r.tcw for r in model.term_counts.collect()}
    assert terms[("A", "rain")] == 1
    # A: 2/3 * 1/2 = 1/3 ; B: 1/3 * 1/1 = 1/3 -> exact tie, both places, by name.
    assert predict(spark, model, ["rain"]) == [[("A", 1 / 3), ("B", 1 / 3)]]


def test_duplicate_input_words_multiply(spark):
    m = messages_df(spark, [message("x y", place="A"), message("x", place="A"), message("x y", place="B")])
    model = bayes.fit_place_model(m)
    # A: 2/3 * (2/2) * (1/2) * (1/2) ; B: 1/3 * 1 * 1 * 1
    got = predict(spark, model, ["x y y"])
    assert got == [[("B", 1 / 3)]]


def test_three_way_tie_keeps_first_two_by_name(spark):
    m = messages_df(spark, [message("w", place=p) for p in ("C", "A", "B")])
    model = bayes.fit_place_model(m)
    assert predict(spark, model, ["w"]) == [[("A", 1 / 3), ("B", 1 / 3)]]


def test_two_way_tie_below_top_is_not_reported(spark):
    m = messages_df(spark, [message("w", place="A"), message("w", place="A"),
                            message("w", place="B"), message("w", place="C")])
    model = bayes.fit_place_model(m)
    assert predict(spark, model, ["w"]) == [[("A", 0.5)]]


def test_long_input_underflow_and_log_rank(spark):
    rows = [message("a b", place="P")] + [message("a", place="P")] * 3 + [message("a b", place="Q"),
                                                                         message("a", place="Q")]
    m = messages_df(spark, rows)
    model = bayes.fit_place_model(m)
    text = " ".join(["b"] * 1200)
    # P: 4/6 * (1/4)^1200 and Q: 2/6 * (1/2)^1200 both underflow to 0.0 -> blank by the reference rule.
    assert predict(spark, model, [text]) == [[(None, None)]]
    # Ranking by the log score picks Q (the larger one), with its underflowed prob.
    assert predict(spark, model, [text], rank_by="log_prob") == [[("Q", 0.0)]]
    scores = bayes.score_places(model, spark.createDataFrame([(0, text)], "input_id long, text string"),
                                with_log=True).collect()
    by_place = {r.place_name: r for r in scores}
    assert by_place["P"].prob == 0.0 and by_place["Q"].prob == 0.0
    assert by_place["Q"].log_prob > by_place["P"].log_prob > -2000


def test_empty_tokens_are_words(spark):
    m = messages_df(spark, [message("a  b", place="A"), message("a b", place="B")])
    model = bayes.fit_place_model(m)
    # 'a  b' has the empty token; only A holds it.
    assert predict(spark, model, ["a  b"]) == [[("A", 0.5)]]


def test_vocabulary_restricted_model_gives_same_scores(spark, golden_messages, model):
    texts = [t for t, _, _ in GOLDEN] + ["hello", "ben", "state hello"]
    inputs = spark.createDataFrame(list(enumerate(texts)), "input_id long, text string")
    small = bayes.fit_place_model(golden_messages, vocabulary=bayes.input_vocabulary(inputs))
    full = sorted(map(tuple, bayes.score_places(model, inputs).collect()))
    restricted = sorted(map(tuple, bayes.score_places(small, inputs).collect()))
    assert full == restricted
    assert small.term_counts.count() < model.term_counts.count()


def test_saved_model_round_trip(spark, model, tmp_path):
    path = str(tmp_path / "model")
    model.save(path)
    loaded = bayes.PlaceModel.load(spark, path)
    assert predict(spark, loaded, ["state building"]) == [[("NewYork", 0.19999999999999998)]]
