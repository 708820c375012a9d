"""Inputs by number, and models stored in buckets."""

import uuid

import pytest
from pyspark.sql import functions as F

from geotally.operators import bayes
from geotally.operators.joins import keep_vocabulary
from helpers import message, messages_df


@pytest.fixture()
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def corpus(spark):
    return messages_df(spark, [message(t, place=p) for p, t in [("a", "x y z"), ("a", "x y"), ("b", "x"), ("b", "z z"), ("c", "y")] * 7])


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_no_exchange_of_the_scorer_carries_a_text(spark, no_broadcast):
    inputs = spark.createDataFrame([(1, "X y"), (2, "x Y"), (3, None), (4, "")], "input_id long, text string")
    model = bayes.fit_place_model(corpus(spark)).materialize()
    batch = bayes.prepare_inputs(inputs)
    assert batch.ids.columns == ["input_id", "__bag"] and "text" not in batch.words.columns
    plan = plan_of(bayes.predict_place(model, batch))
    assert "Exchange" in plan and "text" not in plan.replace("context", "")
    assert rows(batch.ids) == rows(spark.createDataFrame([(1, 0), (2, 0), (4, 1), (3, None)], "input_id long, n long").select(
        "input_id", F.when(F.col("n") == 0, F.lit(batch.ids.where("input_id = 1").first()["__bag"])).when(F.col("n") == 1, F.lit(batch.ids.where("input_id = 4").first()["__bag"])).alias("b")))


def test_texts_of_one_number_get_others(spark):
    tried = []

    def poor(text, seed):
        tried.append(seed)
        return F.when(text.isNotNull(), F.length(text).cast("long")) if seed < 2 else bayes.text_number(text, seed)

    inputs = spark.createDataFrame([(1, "x y"), (2, "y z"), (3, "X Y")], "input_id long, text string")
    model = bayes.fit_place_model(corpus(spark))
    found = bayes.predict_place(model, bayes.prepare_inputs(inputs, poor))
    assert set(tried) == {0, 1, 2}
    assert rows(found) == rows(bayes.predict_place(model, inputs))


def test_an_input_of_very_many_words(spark):
    text = " ".join(["x", "y"] * 50_000)
    inputs = spark.createDataFrame([(1, text), (2, "x")], "input_id long, text string")
    batch = bayes.prepare_inputs(inputs)
    assert batch.words.count() == 3  # a row per different word, not per word
    found = {r.input_id: (r.place_name, r.log_prob) for r in bayes.score_places(bayes.fit_place_model(corpus(spark)), batch, with_log=True).where("place_name = 'a'").collect()}
    import math
    assert found[1][1] == pytest.approx(math.log(14 / 35) + 100_000 * math.log(14 / 14))
    assert found[2][1] == pytest.approx(math.log(14 / 35))


def test_terms_of_a_stored_model_are_not_shuffled(spark, no_broadcast, tmp_path):
    model = bayes.fit_place_model(corpus(spark))
    name = f"m{uuid.uuid4().hex}"
    model.save_tables(name, buckets=5, path=str(tmp_path / "model"))
    stored = bayes.PlaceModel.from_tables(spark, name)
    assert rows(stored.term_counts) == rows(model.term_counts)
    assert rows(stored.class_counts) == rows(model.class_counts)
    inputs = spark.createDataFrame([(1, "x y"), (2, "z"), (3, "q")], "input_id long, text string")
    assert rows(bayes.predict_place(stored, inputs)) == rows(bayes.predict_place(model, inputs))
    batch = bayes.prepare_inputs(inputs)
    from geotally.session import materialize
    plan = plan_of(keep_vocabulary(stored.term_counts, materialize(batch.vocabulary(), "v")))
    assert "Join" in plan and plan.count("Exchange") == 1 and "Bucketed: true" in plan
    # The one exchange deals the words into the stored buckets.
    assert "Exchange hashpartitioning(" in plan and ", 5)" in plan
    scan = next(i for i, line in enumerate(plan.splitlines()) if "Bucketed: true" in line)
    above = plan.splitlines()[:scan]
    exchange = next(i for i, line in enumerate(plan.splitlines()) if "Exchange" in line)
    assert exchange > scan or len(above[exchange]) - len(above[exchange].lstrip(" :+-")) >= len(plan.splitlines()[scan]) - len(plan.splitlines()[scan].lstrip(" :+-"))
    for table in ("class_counts", "term_counts"):
        spark.sql(f"DROP TABLE {name}_{table}")
