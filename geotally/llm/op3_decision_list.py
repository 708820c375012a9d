r"""Quality rules as a learned decision list, in DataFrame functions only.

Statistics of every whole text come first (one pass, no shuffle of texts). Rules are then learned from labelled
statistics by sequential covering: a rule grows by the threshold condition of the largest information gain over
the rows that it still matches, is pruned to the prefix that does best on rows held back, and is kept if it is
precise there; the rows that it covers leave, and the next rule starts. The list becomes one ordered conditional expression.

Learning sees at most ``LABELLED_ROWS`` labelled rows (those of the lowest hash) and, on the driver, only
histograms of a fixed size: features x bins. Everything else covers all rows.

Defined results: null text has no words and fails the base rule; without labels of both kinds there are no learned rules
and every text that passes the base rule is kept; labels that are null are ignored, repeated ones each count; repeated
documents get one row each; other columns are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import lowest_hashes, table, written

LABELLED_ROWS = 50_000
BINS, MAX_RULES, MAX_CONDITIONS = 32, 12, 3
MIN_PRECISION, MIN_COVER = 0.8, 5
SYMBOLS = "#*$%&|<>"
WINDOW = 5
BLANK_RUN = r"[\x20\x09-\x0D]+"
BLANKS = " \t\n\x0b\x0c\r"
STATISTICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Features of the rules, as functions of the statistics.
FEATURES = {
    "words": "n_words",
    "symbols_per_word": "n_symbols / greatest(n_words, 1)",
    "chars_per_word": "word_chars / greatest(n_words, 1)",
    "dup_lines_share": "n_dup_lines / greatest(n_lines, 1)",
    "repeat_share": "n_repeat_words / greatest(n_words, 1)",
    "capitals_share": "n_capitals / greatest(word_chars, 1)",
    "digits_share": "n_digits / greatest(word_chars, 1)",
    "marks_per_word": "n_marks / greatest(n_words, 1)",
    "words_per_line": "n_words / greatest(n_lines, 1)",
    "stutter_share": "n_stutters / greatest(n_words, 1)",
}


def _count_of(characters: str) -> Column:
    """How many characters of ``text`` are among ``characters``."""
    return (F.length("text") - F.length(F.translate("text", characters, ""))).cast("long")


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, and further counts for the features.

    Windows of ``WINDOW`` words are compared by a 64-bit hash; only texts in which a hash occurs twice sort theirs.
    """
    blank = F.lit("")
    base = docs.select("doc_id", F.coalesce("text", blank).alias("text"))
    lines = F.filter(F.split("text", "\n"), lambda x: F.length(F.translate(x, BLANKS, "")) > 0)
    counted = base.select(
        "doc_id", F.filter(F.split("text", BLANK_RUN), lambda w: w != "").alias("w"), lines.alias("lines"),
        F.length(F.translate("text", BLANKS, "")).cast("long").alias("word_chars"), _count_of(SYMBOLS).alias("n_symbols"),
        _count_of("ABCDEFGHIJKLMNOPQRSTUVWXYZ").alias("n_capitals"), _count_of("0123456789").alias("n_digits"), _count_of("!?;:").alias("n_marks"))
    counts = ["word_chars", "n_symbols", "n_capitals", "n_digits", "n_marks"]
    size = F.size("w")
    windows = F.transform(F.sequence(F.lit(0), size - WINDOW), lambda i: F.xxhash64(*[F.get("w", i + k) for k in range(WINDOW)]))
    hashed = counted.select(
        "doc_id", *counts, size.cast("long").alias("n_words"), F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size(F.filter("w", lambda x, i: F.get("w", i - 1) == x)).cast("long").alias("n_stutters"),
        F.when(size >= WINDOW, windows).otherwise(F.expr("cast(array() as array<bigint>)")).alias("h"))
    counts += ["n_words", "n_lines", "n_dup_lines", "n_stutters"]
    order = F.array_sort(F.transform("h", lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
    none = F.expr("cast(array() as array<struct<h:bigint,i:int>>)")
    ordered = hashed.select("doc_id", *counts, F.when(F.size(F.array_distinct("h")) < F.size("h"), order).otherwise(none).alias("s"))
    twice = F.filter("s", lambda x, k: (F.get("s", k - 1)["h"].eqNullSafe(x["h"])) | (F.get("s", k + 1)["h"].eqNullSafe(x["h"])))
    starts = ordered.select("doc_id", *counts, F.array_sort(F.transform(twice, lambda x: x["i"])).alias("r"))
    # Each start covers its window up to the next start.
    cover = F.transform("r", lambda x, k: F.least(F.lit(WINDOW), F.coalesce(F.get("r", k + 1) - x, F.lit(WINDOW))))
    return starts.select("doc_id", *counts, F.aggregate(cover, F.lit(0).cast("long"), lambda a, x: a + x).alias("n_repeat_words"))


BASE_FAILED = "n_words < 10 or 100 * n_repeat_words > 20 * n_words"


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def expression(self) -> Column:
        value = F.expr(FEATURES[self.feature])
        return value > self.threshold if self.above else value <= self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:.6g}"


Rule = tuple[Condition, ...]


def _all(conditions) -> Column:
    return reduce(lambda a, b: a & b, conditions, F.lit(True))


def _gain(bad: int, good: int, was_bad: int, was_good: int) -> float:
    """Information gain of a condition, for the bad rows that remain."""
    if not bad or not was_bad:
        return 0.0
    return bad * (math.log2(bad / (bad + good)) - math.log2(was_bad / (was_bad + was_good)))


def learn(labelled: DataFrame, max_rules: int = MAX_RULES) -> list[Rule]:
    """``labelled``: the statistics, ``bad`` (0 or 1) and ``held`` (true: for pruning). Rules in order."""
    names = list(FEATURES)
    values = labelled.select(*[F.expr(FEATURES[n]).cast("double").alias(n) for n in names], "bad", "held")
    shares = [i / BINS for i in range(1, BINS)]
    cuts = values.agg(*[F.percentile_approx(n, shares, 10_000).alias(n) for n in names]).first()
    cuts = [sorted(set(c or ())) for c in cuts]
    if not any(cuts):
        return []
    # Bin k of a feature holds the values above the first k cuts, so a condition compares a bin with a number.

    def bin_of(name: str, own: list[float]) -> Column:
        return F.size(F.filter(F.array(*map(F.lit, own)), lambda t: t < F.col(name))) if own else F.lit(0)

    bins = F.array(*map(bin_of, names, cuts))
    rows = written(values.select(bins.alias("bins"), "bad", "held"), "labelled")

    def matches(condition: tuple[int, bool, int]) -> Column:
        at, above, k = condition
        return F.get("bins", F.lit(at)) > k if above else F.get("bins", F.lit(at)) <= k

    rules: list[list[tuple[int, bool, int]]] = []
    while len(rules) < max_rules:
        left = rows.where(_all([~_all(map(matches, r)) for r in rules]))
        grown: list[tuple[int, bool, int]] = []
        while len(grown) < MAX_CONDITIONS:
            counted = left.where(~F.col("held") & _all(map(matches, grown))).select(F.posexplode("bins").alias("at", "bin"), "bad").groupBy("at", "bin").agg(F.sum("bad").alias("bad"), F.count("*").alias("n")).collect()
            table_of = {(r["at"], r["bin"]): (r["bad"], r["n"] - r["bad"]) for r in counted}
            total = [sum(v[i] for (at, _), v in table_of.items() if at == 0) for i in (0, 1)]
            if not total[0] or not total[1]:
                break
            best = (0.0, None)
            for at, c in enumerate(cuts):
                low = [0, 0]
                for k in range(len(c)):
                    low = [a + b for a, b in zip(low, table_of.get((at, k), (0, 0)), strict=True)]
                    for above, (bad, good) in ((False, low), (True, [t - x for t, x in zip(total, low, strict=True)])):
                        if bad + good >= MIN_COVER:
                            best = max(best, (_gain(bad, good, *total), (at, above, k)), key=lambda x: x[0])
            if best[1] is None or best[0] < 1:
                break
            grown.append(best[1])
        if not grown:
            break
        # Prefixes of the rule on the rows held back: the one of the largest surplus of bad rows, if it is precise.
        sums = [F.sum(F.when(_all(map(matches, grown[:i])), x)) for i in range(1, len(grown) + 1) for x in (F.col("bad"), 1 - F.col("bad"))]
        found = [x or 0 for x in left.where("held").agg(*sums).first()]
        scored = [(bad - good / (1 - MIN_PRECISION) * MIN_PRECISION, -i, bad, good) for i, (bad, good) in enumerate(zip(found[::2], found[1::2], strict=True), start=1)]
        surplus, size, bad, good = max(scored)
        if bad < 1 or bad / (bad + good) < MIN_PRECISION:
            break
        rules.append(grown[:-size])
    return [tuple(Condition(names[at], above, cuts[at][k]) for at, above, k in r) for r in rules]


def rejecting_rule(rules: list[Rule]) -> Column:
    """The number of the first rule that a text's statistics satisfy, from 1; null if none does."""
    out = F.lit(None).cast("int")
    if rules:
        out = F.when(_all(c.expression() for c in rules[0]), 1)
        for i, rule in enumerate(rules[1:], start=2):
            out = out.when(_all(c.expression() for c in rule), i)
    return out


def labelled_statistics(stats: DataFrame, labels: DataFrame, rows: int = LABELLED_ROWS) -> DataFrame:
    """Statistics of labelled texts with ``bad`` and ``held`` (a third of them, by doc_id), at most ``rows``."""
    marked = labels.where("quality is not null").select("doc_id", F.when(F.col("quality") == 0, 1).otherwise(0).alias("bad"))
    mark = F.xxhash64("doc_id")
    joined = stats.join(marked, "doc_id").withColumn("held", F.pmod(mark, F.lit(3)) == 0)
    return lowest_hashes(joined, ["doc_id", "bad"], rows, marked.count())


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, the statistics, base_failed, rule (number of the learned rule that rejects, else null) and kept."""
    stats = written(statistics(docs), "statistics")
    learnable = stats.where(f"not ({BASE_FAILED})")
    rules = learn(labelled_statistics(learnable, labels))
    judged = stats.withColumn("base_failed", F.expr(BASE_FAILED)).withColumn("rule", rejecting_rule(rules))
    return judged.withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull())


def op3_decision_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select("doc_id", *STATISTICS, "base_failed", "kept", "rule")
