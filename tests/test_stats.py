"""Descriptive analyses: profile, ranked counts, centroids, local hours, ties and zone independence."""

from helpers import message, messages_df
from geotally import schema as S
from geotally.operators import stats


def test_profile_counts_empty_string_and_lengths(spark):
    rows = [
        message("a  b ", user="u1", country="X", place="p", lang="en", lat=1.0, lon=-2.0),
        message("😀😀", user="", country="X", place="q", lang="", lat=3.5, lon=4.0),
        message("hello world", user="u1", country="Y", place="p", lang="en", lat=-1.25, lon=0.5),
    ]
    p = stats.profile(messages_df(spark, rows)).first()
    assert p.n_messages == 3
    assert p.n_distinct_username == 2          # 'u1' and ''
    assert p.n_distinct_country_name == 2
    assert p.n_distinct_place_name == 2
    assert p.n_distinct_language == 2          # 'en' and ''
    assert (p.min_latitude, p.max_latitude) == (-1.25, 3.5)
    assert (p.min_longitude, p.max_longitude) == (-2.0, 4.0)
    # lengths in code points: 5, 2 (emoji count 1 each), 11
    assert p.avg_chars == 18 / 3
    # words = spaces + 1: 'a  b ' -> 4, emoji -> 1, 'hello world' -> 2
    assert p.avg_words == 7 / 3


def test_profile_report_format(spark):
    rows = [message("ab", lat=2.675, lon=0.125), message("abcd", lat=1.0005, lon=-0.5)]
    rep = {r.pos: (r.label, r.value) for r in stats.profile_report(messages_df(spark, rows)).collect()}
    assert len(rep) == 11
    assert rep[1] == ("Number of tweets", "2")
    assert rep[6][1] == f"{1.0005:.3f}" and rep[7][1] == f"{2.675:.3f}"
    assert rep[8][1] == f"{-0.5:.3f}" and rep[9][1] == f"{0.125:.3f}"
    assert rep[10][1] == f"{3.0:.2f}"
    assert rep[11][0] == "The average length of a tweet text is"


def test_count_by_ranks_with_name_ties(spark):
    rows = [message("t", country=c) for c in ["B", "A", "C", "C", "B", "D", "A"]]
    got = [(r.country_name, r.n) for r in stats.count_by(messages_df(spark, rows), S.COUNTRY_NAME).collect()]
    assert got == [("A", 2), ("B", 2), ("C", 2), ("D", 1)]


def test_filtered_city_counts(spark):
    rows = [message("t", place="X"), message("t", place="X", ptype="admin"), message("t", place="Y", code="GB"),
            message("t", place="Z"), message("t", place="X")]
    got = [(r.place_name, r.n) for r in stats.filtered_count_by(messages_df(spark, rows)).collect()]
    assert got == [("X", 2), ("Z", 1)]


def test_centroid_min_count_is_strict(spark):
    rows = [message("t", country="A", lat=float(i), lon=-float(i)) for i in range(11)]
    rows += [message("t", country="B", lat=1.0, lon=1.0) for _ in range(10)]
    got = {r.country_name: r for r in stats.centroid_by(messages_df(spark, rows), min_count=10).collect()}
    assert set(got) == {"A"}
    assert got["A"].n == 11 and got["A"].latitude == 5.0 and got["A"].longitude == -5.0


def test_local_hour_basic_and_negative_epoch(spark):
    rows = [message("t", utc=1500000000123, offset=-18000), message("t", utc=-1500, offset=0),
            message("t", utc=0, offset=-1), message("t", utc=86_399_999, offset=50_400)]
    got = [r.hour for r in stats.local_hours(messages_df(spark, rows)).collect()]
    assert got == [21, 23, 23, 13]


def test_peak_hour_ties_go_to_lower_hour(spark):
    hour_ms = 3_600_000
    rows = ([message("t", country="A", utc=5 * hour_ms, offset=0)] * 2
            + [message("t", country="A", utc=3 * hour_ms, offset=0)] * 2
            + [message("t", country="A", utc=7 * hour_ms, offset=0)]
            + [message("t", country="B", utc=23 * hour_ms, offset=3600)])
    got = {r.country_name: (r.hour, r.n) for r in stats.peak_local_hour(messages_df(spark, rows)).collect()}
    assert got == {"A": (3, 2), "B": (0, 1)}


def test_hours_do_not_depend_on_session_zone(spark):
    rows = [message("t", utc=1500000000123 + k * 977_000, offset=(k % 25 - 12) * 3600) for k in range(200)]
    m = messages_df(spark, rows)
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        utc = sorted(map(tuple, stats.peak_local_hour(m).collect()))
        hours_utc = [r.hour for r in stats.local_hours(m).collect()]
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        ny = sorted(map(tuple, stats.peak_local_hour(m).collect()))
        hours_ny = [r.hour for r in stats.local_hours(m).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert utc == ny and hours_utc == hours_ny


def test_profile_approx_close_to_exact(spark):
    rows = [message("t", user=f"u{i % 997}", country=f"c{i % 7}", place=f"p{i % 31}") for i in range(3000)]
    m = messages_df(spark, rows)
    exact = stats.profile(m).first()
    approx = stats.profile(m, approx=True).first()
    assert exact.n_distinct_username == 997
    assert abs(approx.n_distinct_username - 997) <= 997 * 0.05
    assert approx.n_distinct_country_name == 7 and approx.n_distinct_place_name == 31


def test_peak_hour_without_any_time_is_null(spark):
    m = messages_df(spark, [message("t", utc=None, country="A"), message("t", utc=None, country="B"),
                            message("t", utc=0, offset=3600, country="B")])
    assert sorted(map(tuple, stats.peak_local_hour(m).collect())) == [("A", None, 0), ("B", 1, 1)]
    assert sorted(map(tuple, stats.count_by_local_hour(m).collect()), key=str) == [("A", None, 1), ("B", 1, 1), ("B", None, 1)]
