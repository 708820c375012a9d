"""The kernel against its definition; scores on made texts."""

import itertools
import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from geotally.llm import op5_toxicity as op


def brute_kernel(s, t):
    total = 0.0
    spots = lambda x: [(tuple(x[i] for i in at), at[-1] - at[0] + 1) for at in itertools.combinations(range(len(x)), op.P)]
    theirs = spots(t)
    for letters, span in spots(s):
        total += sum(op.DECAY ** (span + other) for own, other in theirs if own == letters)
    return total


def test_kernel_matches_its_definition():
    rnd = random.Random(1)
    pairs = [("".join(rnd.choice("abcé") for _ in range(rnd.randint(1, 8))), "".join(rnd.choice("abcé") for _ in range(rnd.randint(1, 8)))) for _ in range(200)]
    got = op.kernel([a for a, _ in pairs], [b for _, b in pairs])
    assert np.allclose(got, [brute_kernel(a, b) for a, b in pairs])


VOCABULARY = [a + b + c for a in ("ba", "ke", "lo", "mi", "tu") for b in ("ran", "den", "sil", "mor") for c in ("ta", "pe", "no")]
INSULTS = ["grobian", "zwackel", "finsterling"]


def corpus(n=600):
    rnd = random.Random(4)
    docs, labels = [], []
    for i in range(n):
        toxic = i % 5 == 0
        words = [rnd.choice(VOCABULARY) for _ in range(rnd.randint(5, 40))]
        if toxic:
            words.insert(rnd.randrange(len(words)), rnd.choice(INSULTS) + rnd.choice(["", "s", "."]))
        docs.append((i, " ".join(words) + ".", "x"))
        labels.append((i, int(toxic)))
    return docs, labels


def test_insults_are_found_and_clean_texts_left_alone(spark):
    docs, labels = corpus()
    d = spark.createDataFrame([*docs, (9000, None, "x"), (9001, "", "x"), (0, docs[0][1], "x"), (None, docs[0][1], "x")], "doc_id long, text string, score string").repartition(3)
    l = spark.createDataFrame([*labels, (3, None), (99999, 1)], "doc_id long, toxic int")
    model = op.train(d, l)
    got = {r.doc_id: r.score for r in op.score(d, model).collect()}
    assert len(got) == len(docs) + 3 and all(0 <= s <= 1 for s in got.values())
    held = [(i, t) for i, t in labels if zlib.crc32(str(i).encode()) % 3 == 1]
    assert all((got[i] >= op.THRESHOLD) == bool(t) for i, t in held)
    assert got[9000] == got[9001] < op.THRESHOLD
    more = ["g r o b i a n", "you g-r-o-b-i-a-n", "grob1ian and", "zwackxel", "w" * 200 + "grobian", "bakesil lomorno", " ".join(VOCABULARY) * 50]
    tried = {r.doc_id: r.score for r in op.score(spark.createDataFrame(list(enumerate(more)), "doc_id long, text string"), model).collect()}
    assert all(tried[i] >= op.THRESHOLD for i in range(4)) and tried[5] < op.THRESHOLD and tried[6] < op.THRESHOLD
    kept = op.without_toxic(d, l)
    assert kept.columns == d.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, s in got.items() if s < op.THRESHOLD}


def test_labels_of_the_held_out_third_are_never_read(spark):
    docs, labels = corpus(200)
    d = spark.createDataFrame(docs, "doc_id long, text string, score string")
    turned = [(i, 1 - t if zlib.crc32(str(i).encode()) % 3 == 1 else t) for i, t in labels]
    scores = [sorted(map(tuple, op.score(d, op.train(d, spark.createDataFrame(x, "doc_id long, toxic int"))).collect())) for x in (labels, turned)]
    assert scores[0] == scores[1]


def test_without_labels_and_empty_table(spark):
    docs, _ = corpus(10)
    d = spark.createDataFrame(docs, "doc_id long, text string, score string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r.score < 1e-9 for r in op.score(d, op.train(d, none)).collect()} == {True}
    one = spark.createDataFrame([(i, 0) for i in range(10)], "doc_id long, toxic int")
    assert op.without_toxic(d, one).count() == 10
    assert op.without_toxic(d.where(F.lit(False)), one).count() == 0


def brute_similar(word, landmark):
    """Normalised kernel value by its definition, with the floor and the pair rule."""
    pairs = {(landmark[i], landmark[i + 1]) for i in range(len(landmark) - 1)}
    held = {(word[i], word[j]) for i in range(len(word)) for j in range(i + 1, min(len(word), i + op.REACH + 1))}
    if 2 * len(pairs & held) < len(pairs):
        return 0.0
    value = brute_kernel(word, landmark) / max((brute_kernel(word, word) * brute_kernel(landmark, landmark)) ** 0.5, 1e-12)
    return value if value >= op.FLOOR else 0.0


def test_scores_match_brute_force(spark):
    docs, labels = corpus(150)
    d = spark.createDataFrame(docs, "doc_id long, text string, score string")
    model = op.train(d, spark.createDataFrame(labels, "doc_id long, toxic int"))
    texts = [t for _, t, _ in docs[:25]] + ["g r o b i a n x1 y z", "", None, "Grobian! grobian grob-ian", "zwackel zwackels finster", "é ß"]
    got = {r.doc_id: r.score for r in op.score(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3), model).collect()}
    for i, text in enumerate(texts):
        tokens = (text or "").lower().split()
        words = {"".join(filter(str.isalpha, t)) for t in tokens}
        run = []
        for t in [*tokens, "--"]:
            letters = "".join(filter(str.isalpha, t))
            if len(letters) == 1:
                run.append(letters)
                continue
            words |= {"".join(run)} if len(run) > 2 else set()
            run = []
        rows = [[brute_similar(f"^{w}$", x) for x in model.landmarks] for w in words if len(w) > 1]
        rows = np.array([r for r in rows if any(r)]).reshape(-1, len(model.landmarks))
        margin = model.margins(rows.max(0, initial=0)[None], rows.sum(0)[None])
        assert abs(got[i] - model.score(margin)[0]) < 1e-5, (i, text)


def test_a_text_read_in_parts_scores_as_a_whole(monkeypatch):
    model = op.Model(["^grobian$", "^grob", "^zwackel$"])
    rnd = random.Random(3)
    text = " ".join(rnd.choice([*VOCABULARY, "grobian", "Zwackels", "g", "r", "o"]) for _ in range(4000))
    whole = op.Reader(model).texts([text, None, ""])
    monkeypatch.setattr(op, "SLICE_BYTES", 100)
    monkeypatch.setattr(op, "PART", 50)
    monkeypatch.setattr(op, "MEMORY_BYTES", 4000)
    for a, b in zip(whole, op.Reader(model).texts([text, None, ""]), strict=True):
        assert np.allclose(a, b)
    assert whole[0][0].max() > 0.9 and not whole[0][1:].any()


def test_query_flags_rows_without_an_id(spark, tmp_path):
    docs, labels = corpus(60)
    spark.createDataFrame([*docs, (None, "grobian", "x")], "doc_id long, text string, source string").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    rows = op.op5_toxicity(spark, str(tmp_path)).collect()
    assert {r.doc_id: r.held_out for r in rows} == {i: i is not None and zlib.crc32(str(i).encode()) % 3 == 1 for i in [*range(60), None]}
