"""The pipeline on the smallest tables, and on planted cases."""

import random

import corpus_pipeline as pipeline
from geotally.llm import op1_sentencepiece

SF = "/root/testdata/sf0.001"


def test_stages_are_those_of_the_contract():
    assert [n for n, _ in pipeline.STAGES] == ["toxicity", "simhash_near_dedup", "substring_dedup", "benchmark_decontamination", "sentencepiece"]


def test_run_encodes_what_the_stages_keep(spark):
    out = pipeline.run(spark, SF).collect()
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert {r.doc_id for r in out} <= set(docs) and len(out) > 0.8 * len(docs)
    assert all(r.n_tokens == len(r.ids) == len(r.begins) == len(r.ends) for r in out)


def test_planted_cases(spark, tmp_path):
    rnd = random.Random(12)
    word = lambda: "".join(rnd.choice("abcdefghijklmnoprstuv") for _ in range(rnd.randint(3, 8)))
    text = lambda n: " ".join(word() for _ in range(n))
    docs = {i: text(120) for i in range(60)}
    passage, item = text(60), text(30)
    docs[10] = docs[3]                                                   # an exact copy
    docs[20] = f"{text(40)} {passage} {text(40)}"
    docs[21] = f"{text(50)}\n{passage}\n{text(30)}"                      # a repeated passage
    docs[30] = f"{text(30)} {item} {text(30)}"                           # a benchmark passage
    for i in range(100, 220):                                            # labelled texts, a third of them toxic
        docs[i] = text(40) + (" schurkenpack" if i % 3 == 0 else "")
    labels = [(i, 1, int(i % 3 == 0)) for i in range(100, 220)]
    docs[40] = f"{text(20)} schurkenpack {text(20)}"                     # toxic, without a label
    folder = str(tmp_path)
    spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in docs.items()], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    kept = {r.doc_id: r for r in pipeline.run(spark, folder).collect()}
    toxic = {i for i in docs if "schurkenpack" in docs[i]}
    assert set(docs) - set(kept) == toxic | {10}
    clean = set(kept) - {21, 30}
    model = op1_sentencepiece.Model(open(op1_sentencepiece.default_model(), "rb").read())
    assert all(list(kept[i].ids) == model.encode(docs[i].encode())[0].tolist() for i in clean)
    decoded = {i: model.decoder.decode(list(kept[i].ids)) for i in (20, 21, 30)}
    assert decoded[20] == docs[20] and passage not in decoded[21] and item not in decoded[30]
    assert len(decoded[21].split()) == 80 and len(decoded[30].split()) == 60
