"""Encoding against the library, with normalisers of several kinds; alignment against the library's own offsets."""

import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece
from sentencepiece import sentencepiece_model_pb2 as format

from geotally.llm import op1_sentencepiece as op

PATH = public_tokenizers.path("piece_bpe_32k.model")
TEXTS = ["", " ", "a", "  two  spaces ", "line\nbreak\ttab", "▁mark ▁▁marks▁", "日本語 テキスト 🙂🙂", "nul\0byte", "<s> </s> <unk> <0x0A>",
         "word " * 3000, "x" * 5000, "é́ ﬁ ① Ａ　x", "ends with space ", "  "]


def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def test_ids_digests_and_decoding_match_the_library(spark):
    rows = [(i, t, "x") for i, t in enumerate(TEXTS)] + [(100, None, "y"), (0, "", "again"), (None, "a", "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string").repartition(3)
    lib = library()
    expected = []
    for i, t, _ in rows:
        ids = lib.encode(t or "", add_bos=True, add_eos=True)
        raw = b"".join(x.to_bytes(4, "little") for x in ids)
        expected.append((i, len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256(lib.decode(ids).encode()).hexdigest()))
    got = [tuple(r)[:4] for r in op.encode_digests(docs, PATH).collect()]
    assert sorted(got, key=str) == sorted(expected, key=str)
    encoded = op.encode(docs, PATH)
    decoded = {r.doc_id: r.text for r in op.decode(encoded, PATH).collect() if r.doc_id is not None}
    assert decoded == {i: lib.decode(lib.encode(t or "")) for i, t, _ in rows if i is not None}
    assert op.encode(docs.limit(0), PATH).count() == 0


def test_spans_cover_the_source_in_order():
    model = op.Model(open(PATH, "rb").read())
    for text in TEXTS:
        raw = text.encode()
        ids, begins, ends = model.encode(raw, bos=False, eos=False)
        assert b"".join(raw[a:b] for a, b in zip(begins, ends, strict=True)) == raw
        assert (begins[1:] == ends[:-1]).all() and (not len(ids) or (begins[0] == 0 and ends[-1] == len(raw)))


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nfkc_cf", "identity"])
@pytest.mark.parametrize("dummy,squeeze,escape", [(True, True, True), (False, True, False), (True, False, True), (False, False, True)])
def test_normalisation_and_alignment_match_the_library(rule, dummy, squeeze, escape):
    proto = format.ModelProto.FromString(open(PATH, "rb").read())
    spec = format.NormalizerSpec.FromString(sentencepiece.SentencePieceNormalizer(rule_name=rule).serialized_normalizer_spec())
    spec.add_dummy_prefix, spec.remove_extra_whitespaces, spec.escape_whitespaces = dummy, squeeze, escape
    proto.normalizer_spec.CopyFrom(spec)
    serialized = proto.SerializeToString()
    mine, lib = op.Model(serialized), sentencepiece.SentencePieceProcessor(model_proto=serialized)
    rnd = random.Random(4)
    for _ in range(400):
        text = "".join(rnd.choice("aA ﬁ①Ａ é́́　  \tｶﾞ㍿½ß ǅ가각ﷺ▁") for _ in range(rnd.randint(0, 14)))
        normal, at = mine.normalise(text.encode())
        expected, offsets = lib.normalize(text, with_offsets=True)
        assert normal.decode() == expected
        assert mine.encode(text.encode(), False, False)[0].tolist() == lib.encode(text)
        if normal:
            sizes = [0]
            for c in expected:
                sizes.append(sizes[-1] + len(c.encode()))
            assert [int(at[s]) for s in sizes] == [len(text[:k].encode()) for k in offsets]


def test_memory_may_run_out(monkeypatch):
    monkeypatch.setattr(op, "MEMORY_BYTES", 2000)
    model, lib = op.Model(open(PATH, "rb").read()), library()
    for text in ["a b c d e f g", "a h i", " b  c d", "x y z a"]:
        assert model.encode(text.encode())[0].tolist() == lib.encode(text, add_bos=True, add_eos=True)


def test_memory_stays_within_its_bytes_for_many_and_for_long_chunks():
    import tracemalloc

    own = op.Model(open(op.default_model(), "rb").read())
    rnd = random.Random(5)
    tracemalloc.start()
    before = tracemalloc.get_traced_memory()[0]
    for i in range(30):  # 300,000 different chunks, and texts without a blank
        own.encode(" ".join(f"w{rnd.getrandbits(60)}" for _ in range(10_000)).encode())
        own.encode("".join(chr(0x4E00 + rnd.randrange(5000)) for _ in range(20_000)).encode())
    assert tracemalloc.get_traced_memory()[0] - before < 1.3 * op.MEMORY_BYTES
    assert max(map(len, {**own.memory, **own.older})) <= op.LONG_CHUNK
    tracemalloc.stop()
    text = " ".join(f"word{i % 700} x{i}" for i in range(200_000))
    assert own.encode(text.encode())[0].tolist() == [own.bos, *own.decoder.encode(text), own.eos]
