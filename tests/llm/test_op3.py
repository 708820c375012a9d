"""Statistics against brute force; learned rules on made texts."""

import random
import re
from collections import Counter

from pyspark.sql import functions as F

from geotally.llm import op3_decision_list as op


def brute(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    covered = {j for i in range(len(w) - 4) if windows[tuple(w[i : i + 5])] > 1 for j in range(i, i + 5)}
    seen, again = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            again += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), again, len(covered)


def texts():
    rnd = random.Random(1)
    out = [None, "", " \n\t", "a b c d e a b c d e", "x " * 40, "a b a b a b a b", "l\nl\nl \n\n \nl", "é🙂 #$ <b>\x0b\x85\xa0z", "one " * 2000]
    for _ in range(150):
        out.append("".join(rnd.choice(["a", "b", "c ", " ", "\n", "%", "é"]) for _ in range(rnd.randint(0, 120))))
    return out


def test_statistics_match_brute_force(spark):
    rows = list(enumerate(texts()))
    docs = spark.createDataFrame([(i, t, 5) for i, t in rows], "doc_id long, text string, n_words long").repartition(3)
    got = {r[0]: tuple(r)[1:] for r in op.statistics(docs).select("doc_id", *op.STATISTICS).collect()}
    assert got == {i: brute(t) for i, t in rows}


def made(n=400):
    rnd = random.Random(8)
    vocabulary = [f"{a}{b}{c}" for a in "abcdefg" for b in "aeiou" for c in "klmnopr"]
    docs, labels = [], []
    for i in range(n):
        kind = i % 4
        w = [rnd.choice(vocabulary) for _ in range(rnd.randint(30, 80))]
        if kind == 0:
            w = [x + rnd.choice(["%%%", "***"]) for x in w]
        if kind == 1:
            w = [x.upper() for x in w]
        docs.append((i, " ".join(w)))
        labels.append((i, int(kind > 1)))
    return docs, labels


def test_rules_are_found_and_emitted(spark):
    docs, labels = made()
    d = spark.createDataFrame([*docs, (9000, None), (9001, "short text"), (5, docs[5][1])], "doc_id long, text string")
    l = spark.createDataFrame([*labels, (7, None), (12345, 0)], "doc_id long, quality int")
    got = {r.doc_id: r for r in op.judge(d, l).collect()}
    assert all(got[i].kept == bool(q) for i, q in labels)
    assert not got[9000].kept and got[9000].base_failed and got[9001].base_failed
    rules = op.learn(op.labelled_statistics(op.statistics(d).where(f"not ({op.BASE_FAILED})"), l))
    assert 1 <= len(rules) <= 3 and all(len(r) <= op.MAX_CONDITIONS for r in rules)


def test_no_python_in_the_plan(spark):
    docs, labels = made(60)
    df = op.judge(spark.createDataFrame(docs, "doc_id long, text string").repartition(2), spark.createDataFrame(labels, "doc_id long, quality int"))
    assert not re.search("Python|Pandas|Arrow", df._jdf.queryExecution().executedPlan().toString())


def test_without_labels_only_the_base_rule(spark):
    docs, _ = made(20)
    none = spark.createDataFrame([], "doc_id long, quality int")
    d = spark.createDataFrame([*docs, (99, "")], "doc_id long, text string")
    assert op.judge(d, none).where(F.col("kept")).count() == 20
    assert op.judge(d.limit(0), none).count() == 0
