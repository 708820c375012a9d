"""Plan shape: no Python evaluation, no cartesian products, pruned scans, partial top-k before shuffles,
and identical results for 1, 4 and 64 shuffle partitions."""

import pytest

from helpers import SF001
from geotally.plans import catalog


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_no_python_eval_and_no_cartesian(spark, name):
    plan = plan_text(catalog.queries()[name](spark, SF001))
    for bad in ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "CartesianProduct",
                "BroadcastNestedLoopJoin", "Scan ExistingRDD"):
        assert bad not in plan, f"{name}: {bad}"


def test_count_by_country_prunes_text(spark):
    plan = plan_text(catalog.queries()["count_by_country"](spark, SF001))
    doc_scans = [ln for ln in plan.splitlines() if "documents.parquet" in ln]
    assert doc_scans and all("text" not in ln.split("ReadSchema")[1] for ln in doc_scans)


def test_top_words_uses_partial_group_limit(spark):
    plan = plan_text(catalog.queries()["top_words_in_top_places"](spark, SF001))
    assert "WindowGroupLimit" in plan and "Partial" in plan
    assert "TakeOrderedAndProject" in plan or "limit" in plan.lower()


def test_predict_uses_partial_group_limit(spark):
    plan = plan_text(catalog.queries()["predict_place"](spark, SF001))
    assert "WindowGroupLimit" in plan


def test_stopwords_removed_before_count(spark):
    plan = plan_text(catalog.queries()["word_counts"](spark, SF001))
    lines = plan.splitlines()
    anti = next(i for i, ln in enumerate(lines) if "LeftAnti" in ln)
    partial = next(i for i, ln in enumerate(lines) if "partial_count" in ln)
    assert anti > partial  # printed below = executed before the partial aggregate


def test_peak_hour_single_exchange_on_key(spark):
    plan = plan_text(catalog.queries()["peak_local_hour"](spark, SF001))
    assert plan.count("hashpartitioning(country_name") == 1


INVARIANT = ["word_counts", "top_words_in_top_places", "peak_local_hour", "predict_place", "profile",
             "centroid_by_country"]


@pytest.mark.parametrize("name", INVARIANT)
def test_same_result_for_1_4_64_partitions(spark, name):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    old_aqe = spark.conf.get("spark.sql.adaptive.enabled")
    results = []
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        for n in (1, 4, 64):
            spark.conf.set("spark.sql.shuffle.partitions", str(n))
            results.append(sorted(map(tuple, catalog.queries()[name](spark, SF001).collect())))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.set("spark.sql.adaptive.enabled", old_aqe)
    assert results[0] == results[1] == results[2]


def test_documents_shuffled_once_in_sort_merge_join(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        plan = plan_text(catalog.queries()["word_counts"](spark, SF001))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "SortMergeJoin" in plan
    assert plan.count("hashpartitioning(doc_id") == 1
    # narrow per-event side joined first: the documents' join is the last one, on doc_id = event_id
    assert plan.count("hashpartitioning(event_id") == 1 and plan.count("hashpartitioning(user_id") == 1


# Queries that write while they are built: the model and the inputs that scoring reads many times, files that are read back,
# and the sketch whose bound decides how the top words are found.
WRITING = {"score_places", "predict_place", "predict_place_full_model", "predict_place_stored_model", "bounds_from_files",
           "archive_round_trip", "numbered_lines", "top_words"}


def test_building_a_query_starts_no_job(spark):
    tracker = spark.sparkContext.statusTracker()
    for name, query in catalog.queries().items():
        if name not in WRITING:
            spark.sparkContext.setJobGroup(f"build-{name}", name)
            query(spark, SF001)
            assert list(tracker.getJobIdsForGroup(f"build-{name}")) == [], name
    spark.sparkContext._jsc.clearJobGroup()


def large_plan(spark, name):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        return plan_text(catalog.queries()[name](spark, SF001)).splitlines()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def projections_below(lines, exchange):
    """The column lists of the first Project below each such exchange."""
    at = [i for i, ln in enumerate(lines) if exchange in ln]
    return [next(ln for ln in lines[i:] if "Project [" in ln) for i in at]


@pytest.mark.parametrize("name", ["text_lengths", "profile", "profile_report"])
def test_lengths_are_taken_before_the_exchange(spark, name):
    found = projections_below(large_plan(spark, name), "Exchange hashpartitioning(doc_id")
    assert found and all("AS text_chars" in ln and ", text#" not in ln and "[text#" not in ln for ln in found)


def test_top_words_filters_places_before_the_join(spark):
    lines = large_plan(spark, "top_words_in_top_places")
    at = [i for i, ln in enumerate(lines) if "Exchange hashpartitioning(doc_id" in ln]
    with_text = [i for i in at if ", text#" in next(ln for ln in lines[i:] if "Project [" in ln)]
    assert with_text and all(any("BroadcastHashJoin [source" in x for x in lines[i : i + 4]) for i in with_text)
