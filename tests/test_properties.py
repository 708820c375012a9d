"""Property tests: Spark expressions against plain Python on random inputs (one Spark job per batch)."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from helpers import message, messages_df
from geotally.functions import py_float
from geotally.operators import stats, words
from geotally.sources.words import word_list

SETTINGS = settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))

EPOCH = dt.datetime(1970, 1, 1)


def python_hour(utc_ms, offset_s):
    return (EPOCH + dt.timedelta(seconds=utc_ms // 1000 + offset_s)).hour


@SETTINGS
@given(st.lists(st.tuples(st.integers(-10**12, 4 * 10**12), st.integers(-14 * 3600, 14 * 3600)),
                min_size=1, max_size=200))
def test_local_hour_matches_python(spark, pairs):
    m = messages_df(spark, [message("t", utc=u, offset=o) for u, o in pairs])
    got = [r.hour for r in stats.local_hours(m).collect()]
    assert got == [python_hour(u, o) for u, o in pairs]


TEXT = st.text(alphabet=st.sampled_from(list("ab ABİé\n,") + ["😀", "ß", "Σ"]), max_size=30)


@SETTINGS
@given(st.lists(TEXT, min_size=1, max_size=60))
def test_tokens_and_word_counts_match_python(spark, texts):
    m = messages_df(spark, [message(t) for t in texts])
    p = stats.text_lengths(m).first()
    assert p.avg_words == sum(t.count(" ") + 1 for t in texts) / len(texts)
    assert p.avg_chars == sum(len(t) for t in texts) / len(texts)
    got = sorted(r.word for r in words.word_tokens(m).collect())
    want = sorted(w.lower() for t in texts for w in t.split(" ") if len(w) > 2)
    assert got == want
    counts = [(r.word, r.n) for r in words.word_counts(m, word_list(spark, ["abc"])).collect()]
    from collections import Counter
    c = Counter(w for w in want if w != "abc")
    assert counts == sorted(c.items(), key=lambda kv: (-kv[1], kv[0]))


@SETTINGS
@given(st.lists(st.floats(allow_nan=False), min_size=1, max_size=300))
def test_py_float_matches_str(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    assert [r[0] for r in df.select(py_float("x")).collect()] == [str(v) for v in values]


WORDS = ["a", "b", "c", "dd", "E", ""]


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.sampled_from(["P", "Q", "R", "S"]),
                          st.lists(st.sampled_from(WORDS), min_size=1, max_size=5)), min_size=1, max_size=40),
       st.lists(st.lists(st.sampled_from(WORDS + ["zz"]), min_size=1, max_size=4), min_size=1, max_size=8))
def test_predictions_match_brute_force(spark, corpus, queries):
    from geotally.operators import bayes
    from test_scale import brute_predict
    rows = [message(" ".join(ws), place=p) for p, ws in corpus]
    texts = [" ".join(q) for q in queries]
    m = messages_df(spark, rows)
    inputs = spark.createDataFrame(list(enumerate(texts)), "input_id long, text string")
    model = bayes.fit_and_write_place_model(m, vocabulary=bayes.input_vocabulary(inputs))
    got = {}
    for r in bayes.predict_place(model, inputs).collect():
        got.setdefault(r.input_id, []).append((r.place_name, r.prob))
    for i, t in enumerate(texts):
        assert sorted(got[i], key=lambda x: (x[0] is None, x[0])) == brute_predict(rows, t), t


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.sampled_from(["P", "Q", "R", "S", "T", "U", "V"]),
                          st.sampled_from(["US", "GB"]), st.sampled_from(["city", "admin"]),
                          st.lists(st.sampled_from(["aaa", "bbb", "Ccc", "ddd", "the", "ab", "eee", "fff"]),
                                   min_size=1, max_size=6)), min_size=1, max_size=80))
def test_top_words_match_brute_force(spark, corpus):
    from test_scale import brute_top_words
    rows = [message(" ".join(ws), place=p, code=c, ptype=t) for p, c, t, ws in corpus]
    m = messages_df(spark, rows)
    got = [tuple(r) for r in words.top_words_in_top_groups(m, word_list(spark, ["the"]), top_groups_n=3,
                                                         top_words_n=2).collect()]
    assert got == brute_top_words(rows, {"the"}, m=3, n=2)


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(["A", "B", "C"]), st.integers(0, 3 * 86_400_000),
                          st.sampled_from([-3600, 0, 7200])), min_size=1, max_size=120))
def test_peak_hour_matches_brute_force(spark, events):
    from collections import Counter
    rows = [message("t", country=c, utc=u, offset=o) for c, u, o in events]
    got = {r.country_name: (r.hour, r.n) for r in stats.peak_local_hour(messages_df(spark, rows)).collect()}
    want = {}
    counts = Counter((c, python_hour(u, o)) for c, u, o in events)
    for (c, h), n in counts.items():
        best = want.get(c)
        if best is None or n > best[1] or (n == best[1] and h < best[0]):
            want[c] = (h, n)
    assert got == want
