"""Scale paths: the same answers without broadcast joins (the plans used on large tables), and with one place
holding a large share of all rows, checked against brute-force Python on a small fixture."""

import random
from collections import Counter

import pytest

from helpers import SF001, message, messages_df
from geotally.operators import bayes, words
from geotally.plans import catalog
from geotally.sources.words import word_list
from test_oracle import canon, con  # noqa: F401  (fixture)


@pytest.fixture(scope="module")
def no_broadcast(spark):
    """Large-table planning: no estimate-based broadcasts."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


@pytest.mark.parametrize("name", ["count_by_country", "peak_local_hour", "word_counts", "top_words_in_top_places",
                                  "profile", "predict_place", "term_counts"])
def test_sort_merge_join_path_matches_duckdb(spark, con, no_broadcast, name):  # noqa: F811
    df = catalog.queries()[name](spark, SF001)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan
    # every documents scan is shuffled exactly once (on doc_id, straight into the join)
    assert plan.count("hashpartitioning(doc_id") == plan.count("documents.parquet")
    res = con.execute(catalog.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    assert canon([tuple(r) for r in df.collect()], df.columns) == canon(res.fetchall(), ocols)


# ---- skewed fixture ------------------------------------------------------------------------------------------

VOCAB = [f"w{i:02d}" for i in range(40)] + ["the", "and", "of", "x", "yy", ""]
STOP = ["the", "and"]


def skewed_rows(seed=7, n=1500):
    rng = random.Random(seed)
    places = ["HOT"] + [f"p{i:02d}" for i in range(12)]
    rows = []
    for i in range(n):
        place = "HOT" if rng.random() < 0.45 else rng.choice(places[1:])
        k = rng.randint(1, 12)
        text = " ".join(rng.choice(VOCAB[: 10 + (i % 36)]) for _ in range(k))
        rows.append(message(text, place=place, code="US" if rng.random() < 0.9 else "GB",
                            ptype="city" if rng.random() < 0.95 else "admin"))
    return rows


def brute_word_counts(rows, stop):
    c = Counter()
    for r in rows:
        if r[2] != "US":
            continue
        c.update(w.lower() for w in r[10].split(" ") if len(w) > 2 and w.lower() not in stop)
    return sorted(c.items(), key=lambda kv: (-kv[1], kv[0]))


def brute_top_words(rows, stop, m=5, n=10):
    sel = [r for r in rows if r[2] == "US" and r[3] == "city"]
    pc = Counter(r[4] for r in sel)
    top = sorted(pc.items(), key=lambda kv: (-kv[1], kv[0]))[:m]
    out = []
    for place, place_n in top:
        c = Counter(w.lower() for r in sel if r[4] == place for w in r[10].split(" ")
                    if len(w) > 2 and w.lower() not in stop)
        ranked = sorted(c.items(), key=lambda kv: (-kv[1], kv[0]))[:n]
        out += [(place, place_n, i + 1, w, k) for i, (w, k) in enumerate(ranked)]
    return out


def brute_predict(rows, text):
    total = len(rows)
    tc = Counter(r[4] for r in rows)
    tcw = Counter((r[4], w) for r in rows for w in set(r[10].lower().split(" ")))
    words_in = text.lower().split(" ")
    scores = {}
    for place in tc:
        p = 1.0
        for w in words_in:
            p *= tcw[(place, w)] / tc[place]
        scores[place] = (tc[place] / total) * p
    best = max(scores.values())
    if best == 0:
        return [(None, None)]
    return sorted((pl, s) for pl, s in scores.items() if s == best)[:2]


@pytest.fixture(scope="module")
def skewed(spark):
    rows = skewed_rows()
    return rows, messages_df(spark, rows)


def test_skewed_word_counts(spark, skewed):
    rows, m = skewed
    got = [(r.word, r.n) for r in words.word_counts(m, word_list(spark, STOP)).collect()]
    assert got == brute_word_counts(rows, set(STOP))


def test_skewed_top_words(spark, skewed):
    rows, m = skewed
    got = [tuple(r) for r in words.top_words_in_top_groups(m, word_list(spark, STOP)).collect()]
    assert got == brute_top_words(rows, set(STOP))
    assert got[0][0] == "HOT"


def test_skewed_predictions(spark, skewed):
    rows, m = skewed
    texts = ["w01", "w01 w02", "w03 w03 w05", "w39 the", "x", "yy w00", "nothing here", "", "w01  w02"]
    inputs = spark.createDataFrame(list(enumerate(texts)), "input_id long, text string")
    model = bayes.fit_and_write_place_model(m, vocabulary=bayes.input_vocabulary(inputs))
    got = {}
    for r in bayes.predict_place(model, inputs).collect():
        got.setdefault(r.input_id, []).append((r.place_name, r.prob))
    for i, t in enumerate(texts):
        assert sorted(got[i], key=lambda x: (x[0] is None, x[0])) == brute_predict(rows, t), t


def test_no_task_holds_the_raw_rows_of_a_frequent_word(spark, no_broadcast):
    """With one word in every message and all joins by shuffle, each path counts before it joins: the exchange above the
    exploded words takes partial sums, so a task gets a frequent word once per map task at most."""
    n = 4000
    m = messages_df(spark, [message(f"common w{i}", place=f"p{i % 7}") for i in range(n)]).repartition(4)
    vocabulary = spark.createDataFrame([("common",), ("w1",)], "word string")
    stop = spark.createDataFrame([("other",)], "word string")
    model = bayes.fit_place_model(m, vocabulary=vocabulary)
    results = [words.word_counts(m, stop), words.top_words_in_top_groups(m, stop), model.term_counts, model.class_counts]
    for df in results:
        lines = df._jdf.queryExecution().executedPlan().toString().splitlines()
        for i, ln in enumerate(lines):
            if "Exchange hashpartitioning(" in ln and any("Generate explode" in x for x in lines[i:]):
                below = lines[i + 1 :]
                first = next(x for x in below if any(k in x for k in ("HashAggregate", "SortAggregate", "Generate", "Join", "Scan", "WindowGroupLimit")))
                assert "partial_" in first or "Generate" not in first, ln
    counts = {r.word: r.n for r in results[0].collect()}
    assert counts["common"] == n
    assert {(r.place_name, r.tcw) for r in model.term_counts.where("word = 'common'").collect()} == {
        (f"p{k}", len(range(k, n, 7))) for k in range(7)}
