"""TSV source (quotes, empty fields, short/long rows, bad numbers), sinks, float rendering and the batch jobs."""

import glob
import os

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from helpers import GOLDEN_TRAINING
from geotally import schema as S
from geotally.functions import py_float
from geotally.plans import jobs
from geotally.sources import sinks, tsv

SAMPLE_ROW = ["1500000000123", "United States", "US", "city", "NewYork", "en", "Invented Screen", "invented_user",
              "-18000", "17", "empire state building", "12.5", "-34.25"]


def line(fields):
    return "\t".join(fields)


def write_text(path, lines):
    with open(path, "w", encoding="utf-8") as f:
        f.write("\n".join(lines))


def read_dir(path):
    out = []
    for part in sorted(glob.glob(os.path.join(path, "part-*"))):
        with open(part, encoding="utf-8") as f:
            out += f.read().splitlines()
    return out


def test_quotes_empty_fields_and_extra_fields(spark, tmp_path):
    quoted = list(SAMPLE_ROW)
    quoted[10] = 'say "hi" now'
    empty = list(SAMPLE_ROW)
    empty[7] = ""
    extra = SAMPLE_ROW + ["x", "y"]
    p = tmp_path / "m.tsv"
    write_text(p, [line(quoted), line(empty), line(extra)])
    m = tsv.read_messages(spark, str(p))
    rows = m.collect()
    assert m.schema == S.MESSAGE_SCHEMA
    assert rows[0].tweet_text == 'say "hi" now'
    assert rows[1].username == ""
    assert rows[2].longitude == -34.25 and rows[2].utc_time == 1500000000123
    assert m.agg(F.count_distinct("username")).first()[0] == 2


def test_short_row_policies(spark, tmp_path):
    p = tmp_path / "m.tsv"
    write_text(p, [line(SAMPLE_ROW), line(SAMPLE_ROW[:11])])
    with pytest.raises(PySparkException):
        tsv.read_messages(spark, str(p), on_bad="fail").select(S.LATITUDE).collect()
    # A query that does not touch the missing fields still runs.
    assert tsv.read_messages(spark, str(p), on_bad="fail").select(S.TEXT).count() == 2
    nulls = tsv.read_messages(spark, str(p), on_bad="null").collect()
    assert nulls[1].latitude is None and nulls[1].tweet_text == "empire state building"
    good, bad = tsv.read_messages(spark, str(p), on_bad="quarantine")
    assert good.count() == 1 and bad.count() == 1


def test_bad_number_policies(spark, tmp_path):
    row = list(SAMPLE_ROW)
    row[11] = "x"
    p = tmp_path / "m.tsv"
    write_text(p, [line(SAMPLE_ROW), line(row)])
    with pytest.raises(PySparkException):
        tsv.read_messages(spark, str(p)).agg(F.max(S.LATITUDE)).collect()
    assert tsv.read_messages(spark, str(p), on_bad="null").where(F.col(S.LATITUDE).isNull()).count() == 1
    good, bad = tsv.read_messages(spark, str(p), on_bad="quarantine")
    assert good.count() == 1 and bad.first().line == line(row)


def test_tsv_round_trip(spark, tmp_path):
    rows = [SAMPLE_ROW, SAMPLE_ROW[:10] + ['a "b"  c ', "-0.5", "1e-05"]]
    p = tmp_path / "m.tsv"
    write_text(p, [line(r) for r in rows])
    m = tsv.read_messages(spark, str(p))
    out = str(tmp_path / "out")
    sinks.write_tsv(m, out, order_by=[S.TEXT], single_file=True)
    back = tsv.read_messages(spark, out)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, m.collect()))
    assert read_dir(out)[0].split("\t")[12] == "1e-05"


def test_fields_that_would_break_a_line_come_back(spark, tmp_path):
    texts = ["a\nb", "tab\there", "back\\slash", "\\n literal", "\\\\t", "cr\rlf\r\n", "nul\0 \\0", "\\N", "", None, "\\"]
    rows = [(1, "c", "US", "city", "p", "en", "s", f"u{i}", 0, 1, t, None if i else 0.1, -1e-07) for i, t in enumerate(texts)]
    m = spark.createDataFrame(rows, S.MESSAGE_SCHEMA)
    out = str(tmp_path / "out")
    sinks.write_lines(m, sinks.tsv_lines(m, null=tsv.NULL_FIELD), out, ["username"], single_file=True)
    assert len(read_dir(out)) == len(texts)
    back = tsv.read_messages(spark, out, on_bad="null", escaped=True)
    assert sorted(map(tuple, back.collect()), key=str) == sorted(rows, key=str)


def test_inputs_follow_files_and_lines_for_any_splits(spark, tmp_path):
    folder = tmp_path / "inputs"
    folder.mkdir()
    files = {"a.txt": ["first"], "b.txt": [f"b{i:04d} " + "x" * 40 for i in range(300)], "c.txt": ["c0", "", "c2"]}
    for name, lines in files.items():
        write_text(folder / name, lines)
    expected = [x for name in sorted(files) for x in files[name]]
    conf = {"spark.sql.files.maxPartitionBytes": "1000", "spark.sql.files.openCostInBytes": "10"}
    old = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        got = tsv.read_inputs(spark, str(folder))
        assert spark.read.text(str(folder)).rdd.getNumPartitions() > 3
        assert [r.text for r in sorted(got.collect(), key=lambda r: r.input_id)] == expected
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_sample_is_about_one_percent(spark, tmp_path):
    p = tmp_path / "m.tsv"
    write_text(p, [line(SAMPLE_ROW)] * 5000)
    n = tsv.read_messages(spark, str(p), sample=True, seed=5).count()
    assert 10 < n < 110
    m = tsv.read_messages(spark, str(p))
    assert tsv.stable_sample(m, 0.5).count() in (0, 5000)  # identical rows hash alike
    for fraction in (0, 1e-20, 1, 2):
        with pytest.raises(ValueError):
            tsv.stable_sample(m, fraction)


def test_py_float_matches_python(spark):
    vals = [0.6, 0.19999999999999998, 0.025, 0.13333333333333333, 1e-05, 0.0001, 1e16, 1e-300, -0.0, 123.0,
            5e-324, 12345678.9, 2.5e-07]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    assert [r[0] for r in df.select(py_float("x")).collect()] == [str(v) for v in vals]


def test_predict_files_golden(spark, tmp_path):
    training = tmp_path / "train.tsv"
    rows = []
    for place, text in GOLDEN_TRAINING:
        r = list(SAMPLE_ROW)
        r[4], r[10] = place, text
        rows.append(line(r))
    write_text(training, rows)
    inputs = tmp_path / "inputs"
    # The golden inputs and the expected output lines.
    write_text(inputs, ["state", "state building", "state building building building", "empire building",
                        "hello"])
    expected = ["NewYork\t0.6\t", "NewYork\t0.19999999999999998\t", "London\t0.025\t",
                "NewYork\t0.13333333333333333\t", "\t\t"]
    out = str(tmp_path / "out")
    jobs.predict_files(spark, str(training), str(inputs), out, with_text=False)
    assert read_dir(out) == expected
    jobs.predict_files(spark, str(training), str(inputs), out + "2")
    texts = inputs.read_text(encoding="utf-8").split("\n")
    assert read_dir(out + "2") == [f"{t}\t{e}" for t, e in zip(texts, expected, strict=True)]


def test_run_analyses_writes_every_result(spark, tmp_path):
    p = tmp_path / "m.tsv"
    rows = []
    for i, (place, text) in enumerate(GOLDEN_TRAINING * 3):
        r = list(SAMPLE_ROW)
        r[4], r[10], r[1] = place, text, "A" if i % 2 else "B"
        rows.append(line(r))
    write_text(p, rows)
    stop = tmp_path / "stop.txt"
    write_text(stop, ["big", "new"])
    m = jobs.load_messages(spark, str(p))
    from geotally.sources.words import read_stopwords
    out = str(tmp_path / "res")
    jobs.run_analyses(spark, m, out, read_stopwords(spark, str(stop)))
    assert read_dir(f"{out}/result_1")[0] == "Number of tweets\t 15"
    assert read_dir(f"{out}/result_2") == ["B\t8", "A\t7"]
    assert read_dir(f"{out}/result_5") == ["NewYork\t9", "London\t6"]
    words6 = read_dir(f"{out}/result_6")
    assert words6[0] == "state\t12" and not any(w.startswith(("big\t", "new\t")) for w in words6)
    assert read_dir(f"{out}/result_7")[0].startswith("NewYork\tstate\t9\t")
    assert len(read_dir(f"{out}/result_4")) == 2


def test_gzip_input(spark, tmp_path):
    import gzip
    p = tmp_path / "m.tsv.gz"
    with gzip.open(p, "wt", encoding="utf-8") as f:
        f.write("\n".join([line(SAMPLE_ROW)] * 3))
    m = tsv.read_messages(spark, str(p))
    assert m.count() == 3 and m.first().place_name == "NewYork"


def test_inputs_keep_every_line(spark, tmp_path):
    p = tmp_path / "in.txt"
    write_text(p, ["first line", "", "third  line "])
    rows = tsv.read_inputs(spark, str(p)).orderBy("input_id").collect()
    assert [r.text for r in rows] == ["first line", "", "third  line "]


def test_partitioned_parquet_prunes_by_country(spark, tmp_path):
    rows = []
    for code, place in [("US", "NewYork"), ("US", "Boston"), ("GB", "London"), ("US", "NewYork")]:
        r = list(SAMPLE_ROW)
        r[2], r[4] = code, place
        rows.append(line(r))
    p = tmp_path / "m.tsv"
    write_text(p, rows)
    out = str(tmp_path / "pq")
    jobs.main(["convert", "-m", str(p), "-o", out, "--partition-by", "country_code"])
    m = jobs.load_messages(spark, out, "parquet")
    assert m.columns == S.MESSAGE_COLUMNS
    from geotally.operators import stats
    counts = stats.filtered_count_by(m, country_code="US")
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(country_code" in plan and "(country_code" in plan
    assert [(r.place_name, r.n) for r in counts.collect()] == [("NewYork", 2), ("Boston", 1)]


@pytest.mark.parametrize("joins", [False, True])
def test_one_ordered_file_by_joining_parts(spark, tmp_path, monkeypatch, joins):
    df = spark.range(3000).select((F.col("id") * 7919 % 3001).alias("k"), F.format_string("line %d é", "id").alias("v")).repartition(6)
    sinks.write_lines(df, F.concat_ws("|", "k", "v"), str(tmp_path / "one"), ["k"], single_file=True)
    joined = []

    def concat(spark_, first, others):
        # What a file system with concat does; the local one has none.
        joined.extend(others)
        local = [x.removeprefix("file:") for x in (first, *others)]
        with open(local[0], "ab") as target:
            for other in local[1:]:
                target.write(open(other, "rb").read())
                os.remove(other)
        return True

    if joins:
        monkeypatch.setattr(sinks, "_concat", concat)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # else so few rows make one part
    try:
        assert sinks.write_joined(df, F.concat_ws("|", "k", "v"), str(tmp_path / "many"), ["k"]) == joins
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    read = lambda folder: b"".join((folder / n).read_bytes() for n in sorted(os.listdir(folder)) if n.startswith("part-"))
    assert read(tmp_path / "many") == read(tmp_path / "one") and bool(joined) == joins
    assert sum(n.startswith("part-") for n in os.listdir(tmp_path / "many")) == 1
    assert not [n for n in os.listdir(tmp_path) if ".parts-" in n]
    with pytest.raises(FileExistsError):
        sinks.write_joined(df, F.col("v"), str(tmp_path / "many"), ["k"])
    assert sinks.write_joined(df.limit(0), F.col("v"), str(tmp_path / "none"), ["k"])
