"""Phrase collocations by SETM relational mining.

Texts are split into pieces and words. The occurrence relation R1 (piece, position, word) is persisted in that order, in blocks of
whole texts: a block's words are numbered, and the relation is the sequence of their numbers with a 0 after each piece, so that
neighbouring entries are neighbouring positions of a piece. Each round, for phrases of k words:

1. group-count: every block sends one row for each of its phrases, however often it occurs there; the rows of a phrase meet, and give its
   frequency and its global number (that of its first row; phrases of one length never share one);
2. semi-join: the numbers of the frequent phrases go back to the blocks that hold them, and occurrences of all others leave the relation;
3. merge-join: the sorted relation meets itself by piece and adjacent position. Two frequent phrases of k words that start at
   neighbouring positions make one of k + 1; these are numbered by the next round's group-count.

Only R1 and the numbers of frequent phrases are persisted; R2 and on are made again from them in their block, which is cheaper than to
store them.

A phrase of k + 1 words is known by the global numbers of the phrases that it begins and ends with. So occurrences never cross
a shuffle by their word, a word or phrase of any frequency is one row per block, and the vocabulary is neither broadcast nor held
in one place. Words are compared as they are, not as hashes, and counts are exact.

A candidate is a phrase of 2 to ``max_words`` words that occurs ``least`` times or more. Its score is the least over its cuts of
floor(10^6 a a / (l r)), in decimals of 38 digits (counts up to 10^14). It is dropped if a longer candidate that holds it has at least
half its frequency; only those one word longer need a look, since longer ones are no more frequent.

Defined results: null texts are empty; a null language is ``und``; empty texts and empty pieces have no words; repeated rows count each; null doc_ids
count like others; an empty table gives an empty result; other columns are ignored. Texts are never cut: a block holds whole texts, one at least.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import discard, release, table, written

MAX_WORDS, LEAST, TOP, SHARE, SHARES = 3, 10, 2000, 50, 32
UNKNOWN = "und"
#: Entries after which a block of texts is closed, entries of a stored chunk, rows of an Arrow batch.
BLOCK, CHUNK, ROWS = 3 << 20, 1 << 17, 1 << 16
#: Bytes that end a piece, and what they become; it is no part of UTF-8.
ENDS, END = b".,;:!?\x0a\x0b\x0c\x0d", b"\xff"
LOWER = bytes(END[0] if c in ENDS else c + 32 if 65 <= c <= 90 else c for c in range(256))
#: Kinds of rows of a block: its phrases of k words have k.
WORD, CODES = 1, 99
RELATION = "block long, kind int, no int, lang binary, word binary, n long, codes binary"
GROUPS = "block long, no int, a long, b long, n int"


class Numbers(dict):
    """Numbers words as they come."""

    def __init__(self, counter):
        super().__init__({END: 0})
        self.counter = counter

    def __missing__(self, word: bytes) -> int:
        self[word] = number = next(self.counter)
        return number


def words_of(raw: bytes) -> list[bytes]:
    """The words of a text; ``END`` stands between its pieces."""
    return raw.translate(LOWER).replace(END, b" \xff ").split()


def _chunks(codes: np.ndarray) -> list[bytes]:
    return [pa.compress(codes[i : i + CHUNK].astype("<i4").tobytes(), "zstd", asbytes=True) for i in range(0, len(codes), CHUNK)]


def _codes(chunk: bytes, size: int) -> np.ndarray:
    return np.frombuffer(pa.decompress(chunk, 4 * size, "zstd"), "<i4")


def _read_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches (lang, text) to the blocks of R1: a row per word of the block, and its sequence in chunks."""
    from pyspark import TaskContext

    task, blocks = TaskContext.get().partitionId() << 12, count()
    numbers: dict[bytes, Numbers] = {}
    codes, counter = array("i"), count(1)

    def close() -> Iterator[pa.RecordBatch]:
        nonlocal codes, counter
        block, whole = task + next(blocks), np.frombuffer(codes, np.int32)
        n = np.bincount(whole)
        for lang, own in numbers.items():
            del own[END]
            words, ids = list(own), np.fromiter(own.values(), np.int32, len(own))
            for at in range(0, len(words), ROWS):
                part = words[at : at + ROWS]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(part), block)), pa.array(np.full(len(part), WORD, np.int32)), pa.array(ids[at : at + ROWS]), pa.array([lang] * len(part), pa.binary()),
                     pa.array(part, pa.binary()), pa.array(n[ids[at : at + ROWS]]), pa.nulls(len(part), pa.binary())], names=["block", "kind", "no", "lang", "word", "n", "codes"])
        numbers.clear()
        for no, (chunk, at) in enumerate(zip(_chunks(whole), range(0, len(whole), CHUNK), strict=True)):
            row = [block, CODES, no, None, None, min(CHUNK, len(whole) - at), chunk]
            yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, (pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.int64(), pa.binary()), strict=True)], names=["block", "kind", "no", "lang", "word", "n", "codes"])
        codes, counter = array("i"), count(1)

    for batch in batches:
        for lang, text in zip(batch.column(0), batch.column(1), strict=True):
            lang = lang.as_py()
            if lang not in numbers:
                numbers[lang] = Numbers(counter)
            codes.extend(map(numbers[lang].__getitem__, words_of(text.as_py())))
            codes.append(0)
            if len(codes) >= BLOCK:
                yield from close()
    if codes:
        yield from close()


def _count(block: int, heads: dict[int, list[tuple[np.ndarray, np.ndarray]]], codes: np.ndarray, size: int) -> Iterator[pa.RecordBatch]:
    """A row for each phrase of ``size`` words in a block. ``heads[k]``: places among the block's phrases of k words, and
    global numbers, of the frequent ones."""
    own, name = (np.concatenate(x) for x in zip(*heads[1], strict=True))
    names = np.full(int(max(codes.max(initial=0), own.max(initial=0))) + 1, -1, np.int64)
    names[own] = name
    for k in range(1, size):
        # The semi-join, then the merge-join of each occurrence with that at the next position of its piece.
        stays = names[codes] >= 0
        both = np.nonzero(stays[:-1] & stays[1:])[0].astype(np.int32)
        del stays
        keys = codes[both].astype(np.int64)
        keys *= len(names)
        keys += codes[both + 1]
        if k + 1 == size:
            break
        if k + 1 not in heads:
            return
        own, name = (np.concatenate(x) for x in zip(*heads[k + 1], strict=True))
        frequent = np.unique(keys)[own - 1]
        at = np.minimum(np.searchsorted(frequent, keys), len(frequent) - 1)
        held = frequent[at] == keys
        codes = np.zeros(len(codes), np.int32)
        codes[both[held]] = at[held] + 1
        names = np.concatenate(([-1], name))
        del keys, at, held, both
    pairs, n = np.unique(keys, return_counts=True)
    del keys, both, codes
    for at in range(0, len(pairs), ROWS):
        part = pairs[at : at + ROWS]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(part), block)), pa.array(np.arange(at + 1, at + 1 + len(part), dtype=np.int32)), pa.array(names[part // len(names)]), pa.array(names[part % len(names)]),
             pa.array(n[at : at + ROWS].astype(np.int32))], names=["block", "no", "a", "b", "n"])


def _counter(size: int):
    """Blocks (frequent phrases by length, then the sequence of words) to their phrases of ``size`` words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, heads, chunks = None, {}, []

        def close() -> Iterator[pa.RecordBatch]:
            if 1 in heads and chunks:
                yield from _count(current, heads, np.concatenate(chunks), size)

        for batch in batches:
            block, kind = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            cuts = np.nonzero((np.diff(block) != 0) | (np.diff(kind) != 0))[0] + 1
            cuts = [0, *cuts.tolist(), len(block)]
            for begin, end in zip(cuts, cuts[1:], strict=False):
                if begin == end:
                    continue
                if block[begin] != current:
                    yield from close()
                    current, heads, chunks = int(block[begin]), {}, []
                part = batch.slice(begin, end - begin)
                if kind[begin] == CODES:
                    chunks += [_codes(chunk.as_py(), size_.as_py()) for chunk, size_ in zip(part.column(4), part.column(3), strict=True)]
                else:
                    heads.setdefault(int(kind[begin]), []).append((part.column(2).to_numpy(), part.column(3).to_numpy()))
        yield from close()
        pa.default_memory_pool().release_unused()
    return run


def _own():
    return F.shiftleft("block", 32).bitwiseOR(F.col("no").cast("long"))


def _frequent(rows: DataFrame, identity: list[str], least: int, name: str) -> DataFrame:
    """(block, no, number, f, identity) of the phrases that occur ``least`` times or more in all blocks together.

    A phrase has one row per block at most, whatever its frequency."""
    same = Window.partitionBy(*identity)
    # Narrow rows: place and number of a phrase's block in one long, its count there as an integer.
    packed = rows.select(_own().alias("own"), *identity, F.col("n").cast("int").alias("n"))
    met = packed.select("own", *identity, F.sum("n").over(same).alias("f"), F.min("own").over(same).alias("number"))
    return written(met.where(F.col("f") >= least).select(F.shiftright("own", 32).alias("block"), F.col("own").bitwiseAND(F.lit((1 << 32) - 1)).cast("int").alias("no"), *identity, "f", "number"), name)


def mine(docs: DataFrame, max_words: int = MAX_WORDS, least: int = LEAST) -> tuple[DataFrame, DataFrame]:
    """(lang, words, f, prefixes, suffixes, number, a, b) of all frequent phrases of up to ``max_words`` words, and (lang, n).

    ``prefixes[i]``, ``suffixes[i]``: frequencies of the phrase's first, last i + 1 words; ``a``, ``b``: numbers of the phrases of
    one word less that it begins and ends with."""
    source = docs.select(F.coalesce("lang", F.lit(UNKNOWN)).cast("binary").alias("lang"), F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    relation = written(source.mapInArrow(_read_blocks, RELATION), "occurrences")
    words = relation.where(F.col("kind") == WORD)
    totals = written(words.groupBy(F.col("lang").cast("string").alias("lang")).agg(F.sum("n").alias("n")), "totals")
    local = words_ = _frequent(words, ["lang", "word"], least, "frequent-words")
    whole = F.col("number") == _own()
    one = F.array("f")
    phrases = local.where(whole).select(F.col("lang").cast("string").alias("lang"), F.array(F.col("word").cast("string")).alias("words"), "f",
                                        one.alias("prefixes"), one.alias("suffixes"), "number", F.lit(None).cast("long").alias("a"), F.lit(None).cast("long").alias("b"))
    phrases = written(phrases, "phrases")
    found = phrases
    release(docs.sparkSession)
    heads = []
    for size in range(2, max_words + 1):
        heads.append(local.select("block", F.lit(size - 1).alias("kind"), "no", "number", F.lit(None).cast("binary").alias("codes")))
        # The place of the number holds a chunk's length in its rows.
        met = relation.where(F.col("kind") == CODES).select("block", "kind", "no", F.col("n").alias("number"), "codes")
        for rows in heads:
            met = met.union(rows)
        met = met.repartition("block").sortWithinPartitions("block", "kind", "no")
        local = _frequent(met.mapInArrow(_counter(size), GROUPS), ["a", "b"], least, "frequent")
        release(docs.sparkSession)
        left = phrases.select(F.col("number").alias("a"), "lang", "words", "prefixes")
        right = phrases.select(F.col("number").alias("b"), F.element_at("words", -1).alias("last"), "suffixes")
        made = local.where(whole).select("number", "a", "b", "f").join(left, "a").join(right, "b").select(
            "lang", F.concat("words", F.array("last")).alias("words"), "f", F.concat("prefixes", one).alias("prefixes"), F.concat("suffixes", one).alias("suffixes"), "number", "a", "b")
        phrases = written(made, "phrases")
        found = found.union(phrases)
    for table_ in (relation, words_, local):
        discard(table_)
    return found, totals


def collocations(docs: DataFrame, max_words: int = MAX_WORDS, least: int = LEAST, top: int = TOP, share: int = SHARE) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the ``top`` candidates of each language (see the module)."""
    phrases, totals = mine(docs, max_words, least)
    candidates = phrases.where(F.size("words") > 1)
    # The most frequent candidate of one word more that holds a phrase.
    held = candidates.where(F.size("words") > 2).select((F.size("words") - 1).alias("size"), F.explode(F.array("a", "b")).alias("number"), F.col("f").alias("longer"))
    held = held.groupBy("size", "number").agg(F.max("longer").alias("longer"))
    kept = candidates.withColumn("size", F.size("words")).join(held, ["size", "number"], "left").where(F.col("longer").isNull() | (100 * F.col("longer") < share * F.col("f")))
    big = lambda c: c.cast("decimal(14,0)")

    def cut(k):
        return F.struct(big(F.element_at("prefixes", k)).alias("l"), big(F.element_at("suffixes", F.size("words") - k)).alias("r"), k.alias("k"))

    cuts = kept.select("lang", F.array_join("words", " ").alias("phrase"), big(F.col("f")).alias("a"), F.transform(F.sequence(F.lit(1), F.size("words") - 1), cut).alias("cuts"))
    scored = cuts.select("lang", "phrase", "a", F.expr("array_min(transform(cuts, c -> struct((1000000BD * (a * a)) div (c.l * c.r) AS score, c.k AS k, c.l AS l, c.r AS r)))").alias("best"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    # The best of each share of a language first, so that few rows of a large one meet, however many tasks there are.
    shares = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(SHARES))).orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    long = lambda c: F.col(c).cast("long").alias(c.split(".")[-1])
    rows = scored.select("lang", "phrase", long("a"), long("best.l"), long("best.r"), long("best.score"))
    some = rows.withColumn("rank", F.row_number().over(shares)).where(F.col("rank") <= top)
    best = some.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
    return best.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op11_setm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


SQL = rf"""
WITH docs AS (
  SELECT coalesce(lang, '{UNKNOWN}') AS lang,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents
),
pieces AS (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM docs),
sequences AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM pieces),
places AS (SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM sequences),
ones AS (SELECT lang, ws[i] AS w1, count(*) AS f FROM places GROUP BY ALL),
twos AS (SELECT lang, ws[i] AS w1, ws[i + 1] AS w2, count(*) AS f FROM places WHERE i < len(ws) GROUP BY ALL HAVING count(*) >= {LEAST}),
threes AS (SELECT lang, ws[i] AS w1, ws[i + 1] AS w2, ws[i + 2] AS w3, count(*) AS f FROM places WHERE i + 1 < len(ws) GROUP BY ALL HAVING count(*) >= {LEAST}),
holders AS (
  SELECT lang, w1, w2, max(f) AS longer FROM (
    SELECT lang, w1, w2, f FROM threes UNION ALL SELECT lang, w2 AS w1, w3 AS w2, f FROM threes) GROUP BY ALL
),
cuts AS (
  SELECT t.lang, t.w1 || ' ' || t.w2 AS phrase, t.f AS a, 1 AS k, x.f AS l, y.f AS r
  FROM twos t JOIN ones x ON x.lang = t.lang AND x.w1 = t.w1 JOIN ones y ON y.lang = t.lang AND y.w1 = t.w2
  LEFT JOIN holders h ON h.lang = t.lang AND h.w1 = t.w1 AND h.w2 = t.w2
  WHERE h.longer IS NULL OR 100 * h.longer < {SHARE} * t.f
  UNION ALL
  SELECT t.lang, t.w1 || ' ' || t.w2 || ' ' || t.w3, t.f, 1, x.f, y.f
  FROM threes t JOIN ones x ON x.lang = t.lang AND x.w1 = t.w1 JOIN twos y ON y.lang = t.lang AND y.w1 = t.w2 AND y.w2 = t.w3
  UNION ALL
  SELECT t.lang, t.w1 || ' ' || t.w2 || ' ' || t.w3, t.f, 2, x.f, y.f
  FROM threes t JOIN twos x ON x.lang = t.lang AND x.w1 = t.w1 AND x.w2 = t.w2 JOIN ones y ON y.lang = t.lang AND y.w1 = t.w3
),
scores AS (SELECT *, CAST(CAST(1000000 AS HUGEINT) * a * a // (CAST(l AS HUGEINT) * r) AS BIGINT) AS score FROM cuts),
least_cut AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS c FROM scores),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM least_cut WHERE c = 1),
totals AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM ones GROUP BY lang)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= {TOP}
"""
