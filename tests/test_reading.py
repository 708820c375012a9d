"""Archives cut into parts, numbered lines, mergeable profiles, bounds from footers, top words."""

import gzip
import random

import pytest

from geotally import schema as S
from geotally.operators import stats, words
from geotally.plans import jobs
from geotally.sources import archives, tsv
from geotally.sources.words import word_list
from geotally.streaming import incremental
from helpers import message, messages_df


def cut(data, folder, n, seed=1, name="big.tsv.gz.part"):
    rnd = random.Random(seed)
    places = sorted(rnd.sample(range(1, len(data)), n - 1)) if n > 1 else []
    folder.mkdir(parents=True, exist_ok=True)
    for i, (a, b) in enumerate(zip([0, *places], [*places, len(data)], strict=True)):
        (folder / f"{name}{i:03d}").write_bytes(data[a:b])
    return f"{folder}/{name}*"


def lines_of(df):
    return [r.value for r in df.orderBy("archive", "line_no").collect()]


@pytest.mark.parametrize("parts", [1, 2, 7, 40])
def test_an_archive_cut_inside_members_gives_its_lines(spark, tmp_path, monkeypatch, parts):
    rnd = random.Random(parts)
    lines = ["".join(rnd.choice("abé\t\U0001F600 \\") for _ in range(rnd.randint(0, 60))) for _ in range(3000)]
    data = b"".join(gzip.compress("".join(x + "\n" for x in lines[i : i + 1000]).encode()) for i in range(0, 3000, 1000)) + b"\0" * 512
    df = archives.read_archive_lines(spark, cut(data, tmp_path / "x", parts))
    assert lines_of(df) == lines
    assert [r.line_no for r in df.orderBy("line_no").collect()] == list(range(3000))


def test_lines_end_as_in_text_files(spark, tmp_path):
    for i, text in enumerate(["a\r\nb\rc\n\nd", "a\n", "", "\n\n", "x\r", "only", "\r\n" * 5 + "z" * 3_000_000 + "\r\ny"]):
        plain = tmp_path / f"plain{i}.txt"
        plain.write_bytes(text.encode())
        path = cut(gzip.compress(text.encode()), tmp_path / f"a{i}", 2)
        assert lines_of(archives.read_archive_lines(spark, path)) == [r.value for r in spark.read.text(str(plain)).collect()]


def test_several_archives_and_a_missing_part(spark, tmp_path):
    folder = tmp_path / "many"
    for name in ("one", "two"):
        cut(gzip.compress("".join(f"{name} {i}\n" for i in range(500)).encode()), folder, 5, name=f"{name}.part")
    found = archives.read_archive_lines(spark, f"{folder}/*", r"^(\w+)\.part")
    assert {r.archive: r["count"] for r in found.groupBy("archive").count().collect()} == {"one": 500, "two": 500}
    assert found.where("archive = 'two' AND line_no = 7").first().value == "two 7"
    (folder / "one.part004").unlink()
    with pytest.raises(Exception, match="a part is missing"):
        archives.read_archive_lines(spark, f"{folder}/one*").count()


def test_convert_reads_parts(spark, tmp_path):
    text = "".join("\t".join(map(str, message(f"text {i}", utc=i))) + "\n" for i in range(50))
    path = cut(gzip.compress(text.encode()), tmp_path / "c", 3)
    jobs.main(["convert", "-m", path, "--gz-parts", "-o", str(tmp_path / "out")])
    assert sorted(r.utc_time for r in tsv.read_parquet(spark, str(tmp_path / "out")).collect()) == list(range(50))


@pytest.mark.parametrize("split", ["64", "1000", "128m"])
def test_line_numbers_do_not_depend_on_splits(spark, tmp_path, split):
    expected, at = [], 0
    for name, n in (("a.txt", 40), ("b.txt", 0), ("c.txt", 1), ("d.txt", 150)):
        (tmp_path / name).write_text("".join(f"{name} {i} {'x' * (i % 9)}\n" for i in range(n)))
        for i in range(n):
            expected.append((at, i, f"{name} {i} {'x' * (i % 9)}"))
            at += 1
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        df = tsv.read_numbered_lines(spark, str(tmp_path))
        assert sorted((r.number, r.line_no, r.value) for r in df.collect()) == expected
        assert sorted((r.number, r.line_no, r.value) for r in df.collect()) == expected
        assert "rangepartitioning" not in df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def some_messages(spark, n, users=50, seed=3):
    rnd = random.Random(seed)
    return messages_df(spark, [message("w " * rnd.randint(0, 5) + f"é{i}", user=f"u{rnd.randrange(users)}", place=f"p{i % 5}", country=f"c{i % 3}",
                                       lat=rnd.uniform(-90, 90), lon=rnd.uniform(-180, 180)) for i in range(n)])


def test_merged_parts_give_the_profile(spark):
    m = some_messages(spark, 300)
    parts = stats.profile_parts(m, (S.PLACE_NAME,))
    assert parts.count() == 5
    merged, exact = stats.profile_from_parts(parts).first(), stats.profile(m).first()
    assert merged.asDict() == pytest.approx(exact.asDict())
    by_country = {r.country_name: r.n_messages for r in stats.profile_from_parts(stats.profile_parts(m, (S.COUNTRY_NAME, S.PLACE_NAME)), [S.COUNTRY_NAME]).collect()}
    assert by_country == {"c0": 100, "c1": 100, "c2": 100}


def test_parts_of_no_messages(spark):
    empty = stats.profile_from_parts(stats.profile_parts(messages_df(spark, []))).first()
    assert empty.n_messages == 0 and empty.n_distinct_username == 0 and empty.avg_chars is None and empty.min_latitude is None


def test_estimates_stay_within_three_standard_errors(spark):
    m = spark.range(200_000).selectExpr(*[f"cast({'concat(id, \"u\")' if c == S.USERNAME else 'id % 7' if c == S.PLACE_NAME else '0.5' if c in (S.LATITUDE, S.LONGITUDE) else '\"x\"'} as {t}) as {c}"
                                          for c, t in ((f.name, f.dataType.simpleString()) for f in S.MESSAGE_SCHEMA.fields) if c not in (S.UTC_TIME, S.TIMEZONE_OFFSET, S.NUMBER_OF_FRIENDS)])
    got = stats.profile_from_parts(stats.profile_parts(m, (S.PLACE_NAME,))).first()
    assert abs(got.n_distinct_username - 200_000) < 3 * 1.04 / 2**7 * 200_000
    assert got.n_distinct_place_name == 7


def test_stream_of_profiles_reads_new_files_only(spark, tmp_path):
    source, out = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    line = lambda i: "\t".join(map(str, message(f"t {i}", user=f"u{i % 9}", lat=float(i)))) + "\n"
    for day in range(3):
        (source / f"{day}.tsv").write_text("".join(line(i) for i in range(day * 10, day * 10 + 10)))
        incremental.start_profile_updates(incremental.read_message_stream(spark, str(source)), out, available_now=True).awaitTermination()
        assert spark.read.parquet(f"{out}/parts").select("batch_id").distinct().count() == day + 1
    got = incremental.read_running_profile(spark, out).first()
    exact = stats.profile(tsv.read_messages(spark, str(source))).first()
    assert got.asDict() == pytest.approx(exact.asDict())


def test_bounds_come_from_footers(spark, tmp_path):
    m = some_messages(spark, 200)
    tsv.write_parquet(m, str(tmp_path / "m"))
    df = stats.bounds_from_files(spark, str(tmp_path / "m"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(*), MIN(latitude)" in plan
    got, exact = df.first().asDict(), stats.bounds(m).first().asDict()
    assert got.pop("n_messages") == 200 and got == exact
    assert spark.conf.get("spark.sql.sources.useV1SourceList") != ""


@pytest.mark.parametrize("flat", [False, True])
def test_top_words_equal_the_full_ranking(spark, monkeypatch, flat):
    rnd = random.Random(8)
    vocabulary = [f"word{i}" for i in range(4000)]
    draw = (lambda: rnd.choice(vocabulary)) if flat else (lambda: vocabulary[min(3999, int(rnd.paretovariate(0.7)) - 1)])
    m = messages_df(spark, [message(" ".join(draw() for _ in range(40))) for _ in range(700)])
    stopwords = word_list(spark, ["word1", "word4"])
    full = []
    monkeypatch.setattr(words, "word_counts", lambda *a, f=words.word_counts, **k: full.append(1) or f(*a, **k))
    got = words.top_words(m, stopwords, 10, tracked=1024, listed=200)
    assert bool(full) == flat  # flat counts prove nothing, so all words are counted
    assert [tuple(r) for r in got.collect()] == [tuple(r) for r in words.word_counts(m, stopwords).limit(10).collect()]
