"""Addresses, rules and shrinkage."""

import pytest

from pyspark.sql import functions as F

from geotally.llm import op4_reputation as op


def address(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min([i for i in (rest.find(c) for c in "/?#") if i >= 0], default=len(rest))
    path = rest[end:]
    stop = min([i for i in (path.find(c) for c in "?#") if i >= 0], default=len(path))
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:end]), path[:stop]


URLS = ["http://WWW.Example.com/en/1?x=/fr/", "https://a.example.com/en/2#t", "http://example.com/en", "http://b.com/x", "http://b.com", "ftp://net/es/", "http://x.net/fr/3",
        "http://xnet/fr/3", "no scheme", "", None, "http://", "://h/p", "http://a?b/c", "http://ÄÖ.net/es/é", "http://h/a://b", "http://notexample.com/en/1"]


def rule(host, path):
    fits = [(len(h) + len(p), k == "block", h + p, k) for k, h, p in op.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[2:] if fits else (None, None)


def test_addresses_and_rules(spark):
    pages = spark.createDataFrame([(i, u, "z") for i, u in enumerate(URLS)] + [(0, URLS[0], "z")], "page_id long, url string, host string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = [(r.page_id, r.host, r.path, r.rule, r.verdict) for r in op.judge(pages, labels).collect()]
    expected = []
    for i, u in [*enumerate(URLS), (0, URLS[0])]:
        h, p = address(u)
        r, verdict = rule(h, p)
        expected.append((i, h, p, r, verdict or "allow"))
    assert sorted(got, key=str) == sorted(expected, key=str)


@pytest.fixture(scope="module")
def judged(spark):
    urls, labels, n = [], [], 0
    for host, bad, good in (("bad.site.org", 40, 0), ("good.site.org", 0, 200), ("one.bad.site.org", 1, 0), ("mixed.org", 10, 10), ("rare.example.org", 1, 0), ("many.example.org", 2, 120)):
        for k in range(bad + good):
            urls.append((n, f"http://{host}/fr2/{n}.html"))
            labels.append((n, 0 if k < bad else 1, 0))
            n += 1
    urls.append((n, "http://unseen.site.org/x"))
    labels += [(0, None, None), (10**9, 0, 0)]
    found = op.judge(spark.createDataFrame(urls, "page_id long, url string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    return {r.host: r for r in found.collect()}


def test_bounds_follow_evidence(judged):
    assert judged["bad.site.org"].verdict == "block"
    assert all(judged[h].verdict == "allow" for h in ("good.site.org", "mixed.org", "rare.example.org", "unseen.site.org", "many.example.org"))
    assert judged["bad.site.org"].host_labelled == 40
    # One bad page is shrunk towards its domain; an unseen host has its domain's rate and a wide bound.
    assert judged["rare.example.org"].host_rate < 1
    assert judged["unseen.site.org"].host_bound < judged["unseen.site.org"].host_rate


def test_empty_tables(spark):
    pages = spark.createDataFrame([], "page_id long, url string")
    assert op.judge(pages, spark.createDataFrame([(1, 0, 1)], "doc_id long, quality int, toxic int")).count() == 0


def test_suffix_rules(spark, tmp_path):
    (tmp_path / "rules.txt").write_text("// public\ncom\nuk\nco.uk\n\n*.ck\n!www.ck\na.b.Example  // note\n")
    rules = op.Suffixes.read(spark, str(tmp_path / "rules.txt"))
    expected = {"x.y.co.uk": ("y.co.uk", "co.uk"), "co.uk": ("co.uk", "co.uk"), "y.uk": ("y.uk", "uk"), "s.t.foo.ck": ("t.foo.ck", "foo.ck"), "x.www.ck": ("www.ck", "ck"), "www.ck": ("www.ck", "ck"),
                "p.q.a.b.example": ("q.a.b.example", "a.b.example"), "q.b.example": ("b.example", "example"), "host": ("host", "host"), "": ("", ""), "127.0.0.1": ("0.1", "1")}
    df = spark.createDataFrame([(h,) for h in expected], "host string")
    domain, suffix = rules.parts(F.col("host"))
    assert {r.host: (r.d, r.s) for r in df.select("host", domain.alias("d"), suffix.alias("s")).collect()} == expected
