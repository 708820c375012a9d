"""URL filter: explicit rules, and beyond them the empirical-Bayes reputation of the host.

The outcome of a labelled page is bad or not. Bad rates are shrunk from the top down: a suffix towards all pages, a
registered domain towards its suffix, a host towards its registered domain. The strength of each beta prior is the
method-of-moments estimate over the units of that level. A host is blocked when the lower bound of its posterior bad
rate, ``z`` standard deviations below the mean, is above ``limit``; a host that no label speaks of gets its domain's
or its suffix's posterior, or the overall rate.

Defined results: a url that is null or has no ``://`` has empty host and path and is judged as the empty host; null labels
are no outcome; repeated label rows each count; repeated pages get one row each; without any outcome nothing is blocked
but by a rule; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table, written

#: The rules unless others are given. Suffixes under which each name is a site of its own; any other host's suffix is its last label.
TWO_LABEL_SUFFIXES = ("co.uk", "org.uk", "ac.uk", "com.au", "co.jp", "co.nz", "com.br", "co.in", "example.com", "example.net", "example.org")
RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/"))
LIMIT, Z = 0.5, 1.645
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def with_address(pages: DataFrame) -> DataFrame:
    """page_id, host and path of every page."""
    rest = F.when(F.instr("url", "://") > 0, F.expr("substr(url, instr(url, '://') + 3)")).otherwise("")
    split = pages.select("page_id", rest.alias("rest"))
    return split.select("page_id", F.translate(F.regexp_extract("rest", r"^[^/?#]*", 0), UPPER, LOWER).alias("host"),
                        F.regexp_extract("rest", r"^[^/?#]*([^?#]*)", 1).alias("path"))


def longest_rule(rules=RULES) -> tuple[Column, Column]:
    """The rule (host and path) that fits and is longest, and its verdict; null if none fits. Blocks win ties."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, host, path in sorted(rules, key=lambda r: (len(r[1]) + len(r[2]), r[0] == "block")):
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(path)
        text, verdict = F.when(fits, host + path).otherwise(text), F.when(fits, kind).otherwise(verdict)
    return text, verdict


@dataclass(frozen=True)
class Suffixes:
    """Under which names sites are registered. A rule is a suffix (``co.uk``), a wildcard (``*.ck``: each name under ``ck`` is one), or an
    exception to a wildcard (``!www.ck``). The longest that fits a host counts; without one its last label is the suffix."""

    exact: frozenset[str] = frozenset(TWO_LABEL_SUFFIXES)
    wild: frozenset[str] = frozenset()
    exceptions: frozenset[str] = frozenset()

    @staticmethod
    def of(rules: Iterable[str]) -> Suffixes:
        """From lines of the public list's format; empty lines and those that begin with ``//`` say nothing."""
        lines = [x.split()[0].translate(str.maketrans(UPPER, LOWER)) for x in rules if x.strip() and not x.startswith("//")]
        return Suffixes(frozenset(x for x in lines if x[0] not in "*!"), frozenset(x[2:] for x in lines if x.startswith("*.")), frozenset(x[1:] for x in lines if x[0] == "!"))

    @staticmethod
    def read(spark: SparkSession, path: str) -> Suffixes:
        """From a text file of rules: a list of some thousand lines, which the driver holds."""
        return Suffixes.of(r["value"] for r in spark.read.text(path).toLocalIterator())

    def labels(self, host: Column) -> Column:
        """How many labels of the host are its suffix."""
        depth = 1 + max((x.count(".") + 1 for x in (*self.exact, *self.wild, *self.exceptions)), default=0)
        found = F.lit(1)
        for k in range(1, depth + 1):
            last = F.substring_index(host, ".", -k)
            long = F.size(F.split(host, "\\.")) >= k  # else the host has no k labels, and ``last`` is all of it
            listed = last.isin(*sorted(self.exact)) if self.exact else F.lit(False)
            if self.wild and k > 1:
                listed = listed | F.substring_index(host, ".", 1 - k).isin(*sorted(self.wild))
            found = F.when(long & listed, k).otherwise(found)
            if self.exceptions and k > 1:
                found = F.when(long & last.isin(*sorted(self.exceptions)), k - 1).otherwise(found)
        return found

    def parts(self, host: Column) -> tuple[Column, Column]:
        """The registered domain and the suffix of a host."""
        pieces, n = F.split(host, "\\."), self.labels(host)
        last = lambda k: F.array_join(F.slice(pieces, F.greatest(F.size(pieces) - k + 1, F.lit(1)), k), ".")
        return last(n + 1), last(n)


def strength(units: DataFrame) -> float:
    """Prior observations of a level, by moments over its units (n, bad): large if their rates hardly differ."""
    s = units.agg(F.count("*").alias("k"), F.sum("n").alias("n"), F.sum("bad").alias("bad"), F.sum(F.col("n") * F.col("n")).alias("nn"),
                  F.sum(F.col("bad") * F.col("bad") / F.col("n")).alias("between")).first()
    if not s["n"] or s["k"] < 2 or s["bad"] in (0, s["n"]):
        return 1.0
    rate = s["bad"] / s["n"]
    spread = s["between"] - s["n"] * rate * rate
    room = rate * (1 - rate) * (s["n"] - s["nn"] / s["n"] - (s["k"] - 1))
    share = (spread - rate * (1 - rate) * (s["k"] - 1)) / room if room > 0 else 0.0
    return 1 / min(max(share, 1e-3), 0.5) - 1


def outcomes(addresses: DataFrame, labels: DataFrame) -> DataFrame:
    """host, n, bad: labelled pages of each host. A page shows the document whose number ends its path; its outcome
    is bad if that document is labelled as of low quality or toxic."""
    number = F.regexp_extract("path", r"/([0-9]{1,18})(?:\.html|/)?$", 1)
    shown = addresses.where(number != "").groupBy("host", number.cast("long").alias("doc_id")).agg(F.count("*").alias("pages"))
    bad = F.when(F.coalesce(F.col("quality") == 0, F.lit(False)) | F.coalesce(F.col("toxic") == 1, F.lit(False)), 1).otherwise(0)
    judged = labels.where("quality is not null or toxic is not null").groupBy("doc_id").agg(F.count("*").alias("n"), F.sum(bad).alias("bad"))
    return shown.join(judged, "doc_id").groupBy("host").agg(F.sum(F.col("pages") * F.col("n")).alias("n"), F.sum(F.col("pages") * F.col("bad")).alias("bad"))


def reputations(hosts: DataFrame, found: DataFrame, z: float = Z, suffixes_: Suffixes = Suffixes()) -> DataFrame:
    """host, n, bad, posterior mean ``rate`` and its lower ``bound`` for every one of ``hosts``."""
    domain, suffix = suffixes_.parts(F.col("host"))
    seen = written(found.withColumns({"domain": domain, "suffix": suffix}), "outcomes")
    domains = seen.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    suffixes = seen.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    total = suffixes.agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).first()
    overall = ((total["bad"] or 0) + 0.5) / ((total["n"] or 0) + 1)
    k_suffix, k_domain, k_host = strength(suffixes), strength(domains), strength(seen)

    def shrunk(prior: Column, k: float) -> Column:
        n, bad = F.coalesce("n", F.lit(0)), F.coalesce("bad", F.lit(0))
        return (bad + prior * k) / (n + k)

    suffixes = suffixes.select("suffix", shrunk(F.lit(overall), k_suffix).alias("suffix_rate"))
    domains = domains.join(suffixes, "suffix").select("domain", shrunk(F.col("suffix_rate"), k_domain).alias("domain_rate"))
    every = hosts.select("host", domain.alias("domain"), suffix.alias("suffix"))
    every = every.join(seen.select("host", "n", "bad"), "host", "left").join(domains, "domain", "left").join(suffixes, "suffix", "left")
    prior = F.coalesce("domain_rate", "suffix_rate", F.lit(overall))
    weight = F.coalesce("n", F.lit(0)) + F.lit(k_host)
    every = every.select("host", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("bad", F.lit(0)).alias("bad"), shrunk(prior, k_host).alias("rate"), weight.alias("weight"))
    return every.select("host", "n", "bad", "rate", (F.col("rate") - z * F.sqrt(F.col("rate") * (1 - F.col("rate")) / (F.col("weight") + 1))).alias("bound"))


def judge(pages: DataFrame, labels: DataFrame, rules=RULES, limit: float = LIMIT, z: float = Z, suffixes: Suffixes = Suffixes()) -> DataFrame:
    """page_id, host, path, rule, verdict, and the host's labelled pages, posterior rate and bound."""
    addresses = with_address(pages)
    # A host with very many pages is one row per task before the shuffle.
    known = reputations(addresses.groupBy("host").agg(F.count("*").alias("pages")), outcomes(addresses, labels), z, suffixes)
    # Written, so that the join deals both sides anew and Spark can split the pages of such a host.
    known = written(known, "reputations")
    rule, ruled = longest_rule(rules)
    learned = F.when(F.col("bound") > limit, "block").otherwise("allow")
    return addresses.join(known, "host").select("page_id", "host", "path", rule.alias("rule"), F.coalesce(ruled, learned).alias("verdict"),
                                                F.col("n").alias("host_labelled"), F.col("rate").alias("host_rate"), F.col("bound").alias("host_bound"))


def op4_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels")).select("page_id", "host", "path", "rule", "verdict")


def _level(name: str, key: str) -> str:
    return f"""{name}_k AS (SELECT CASE WHEN coalesce(n, 0) = 0 OR k < 2 OR bad = 0 OR bad = n THEN 1.0 ELSE 1 / least(greatest(
  CASE WHEN room > 0 THEN (between_units - n * r * r - r * (1 - r) * (k - 1)) / room ELSE 0 END, 0.001), 0.5) - 1 END AS s
  FROM (SELECT *, r * (1 - r) * (n - nn / n - (k - 1)) AS room FROM (SELECT *, bad / n AS r FROM (
    SELECT count(*)::DOUBLE AS k, sum(n)::DOUBLE AS n, sum(bad)::DOUBLE AS bad, sum(n * n)::DOUBLE AS nn, sum(bad * bad / n)::DOUBLE AS between_units FROM {key}))))"""


def _sql() -> str:
    two = ", ".join(f"'{s}'" for s in TWO_LABEL_SUFFIXES)
    rules = sorted(RULES, key=lambda r: (len(r[1]) + len(r[2]), r[0] == "block"), reverse=True)
    fit = lambda pick: " ".join(f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN '{pick(k, h, p)}'" for k, h, p in rules)
    parts = "array_to_string(list_slice(string_split(host, '.'), -{0}, -1), '.')"
    in_two = f"{parts.format(2)} IN ({two})"
    return f"""
WITH cut AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
a AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{UPPER}', '{LOWER}') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
judged AS (SELECT doc_id, count(*) AS n, sum(CASE WHEN coalesce(quality = 0, false) OR coalesce(toxic = 1, false) THEN 1 ELSE 0 END) AS bad
  FROM labels WHERE quality IS NOT NULL OR toxic IS NOT NULL GROUP BY doc_id),
shown AS (SELECT host, CAST(regexp_extract(path, '/([0-9]{{1,18}})(?:\\.html|/)?$', 1) AS BIGINT) AS doc_id FROM a WHERE regexp_extract(path, '/([0-9]{{1,18}})(?:\\.html|/)?$', 1) <> ''),
parts AS (SELECT host, CASE WHEN {in_two} THEN {parts.format(3)} ELSE {parts.format(2)} END AS domain, CASE WHEN {in_two} THEN {parts.format(2)} ELSE {parts.format(1)} END AS suffix FROM (SELECT DISTINCT host FROM a)),
seen AS (SELECT host, domain, suffix, sum(n) AS n, sum(bad) AS bad FROM shown JOIN judged USING (doc_id) JOIN parts USING (host) GROUP BY ALL),
domains AS (SELECT domain, suffix, sum(n) AS n, sum(bad) AS bad FROM seen GROUP BY ALL),
suffixes AS (SELECT suffix, sum(n) AS n, sum(bad) AS bad FROM seen GROUP BY ALL),
total AS (SELECT (coalesce(sum(bad), 0) + 0.5) / (coalesce(sum(n), 0) + 1)::DOUBLE AS r FROM seen),
{_level('suffix', 'suffixes')}, {_level('domain', 'domains')}, {_level('host', 'seen')},
sr AS (SELECT suffix, (bad + r * s) / (n + s) AS rate FROM suffixes, total, suffix_k),
dr AS (SELECT domain, (bad + rate * s) / (n + s) AS rate FROM domains JOIN sr USING (suffix), domain_k),
hr AS (SELECT p.host, (coalesce(bad, 0) + coalesce(dr.rate, sr.rate, total.r) * s) / (coalesce(n, 0) + s) AS rate, coalesce(n, 0) + s + 1 AS w
  FROM parts p LEFT JOIN seen ON p.host = seen.host LEFT JOIN dr ON p.domain = dr.domain LEFT JOIN sr ON p.suffix = sr.suffix, total, host_k)
SELECT page_id, a.host, path, CASE {fit(lambda k, h, p: h + p)} END AS rule,
  CASE {fit(lambda k, h, p: k)} WHEN rate - {Z} * sqrt(rate * (1 - rate) / w) > {LIMIT} THEN 'block' ELSE 'allow' END AS verdict
FROM a JOIN hr ON a.host = hr.host
""".replace("(host = ", "(a.host = ").replace("ends_with(host", "ends_with(a.host")


SQL = _sql()
