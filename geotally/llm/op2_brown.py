"""Language-model scores from Brown classes: exchange clustering, class transitions and word emissions.

Tokens of a text are its words (runs of anything but the six ASCII blanks, A-Z lower-cased) and one end token. Counts of all
words come from all training texts. Classes are learned for units: the ``OWN`` commonest words are units of their own,
all others share a unit with the words that end alike (their last three bytes, hashed to ``ENDINGS`` groups), so
that every word, seen or not, has a class. Each round of the exchange counts, over all training tokens, how often every unit
stands before and after every class, and then moves each unit in turn to the class that raises the likelihood
of the class bigrams most; the best round's classes are kept. The end token is a class of its own and stands before
every text.

P(text) is the product over tokens of P(class | class before) and P(word | class). Transitions are interpolated with
the class frequencies; emissions are add-one over the class's words and one place for unseen words, so that they
sum to one. Scores are log10; perplexity is 10 ** (-score / n_tokens).

Scale: the driver holds at most ``LEXICON`` words and units x classes counts, whatever the corpus. Words beyond the lexicon, each of
them rare, meet their counts in a shuffle join.

Defined results: null and empty texts have only the end token; without training texts every count is zero; a null doc_id
is never held out; repeated rows are scored (and counted) each by itself; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import slices, table, written

LEXICON, OWN, ENDINGS, CLASSES, ROUNDS = 131_072, 4096, 1024, 32, 5
END_UNIT = OWN + ENDINGS
UNITS = END_UNIT + 1
#: Weight of the class frequencies against the counted transitions.
PRIOR = 8.0
FLUSH_WORDS = 500_000
#: Tokens whose classes are looked up at once (one text at least), and bytes of texts that are encoded at once.
PART_TOKENS, SLICE_BYTES = 1 << 19, 1 << 20


def held_out(doc_id: Column, modulus: int = 7, remainder: int = 2) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(modulus)) == remainder, F.lit(False))


def words_of(text: bytes | None) -> list[bytes]:
    return text.lower().split() if text else []


def ending(word: bytes) -> int:
    return zlib.crc32(word[-3:]) % ENDINGS


def word_counts(texts: DataFrame) -> DataFrame:
    """word (bytes) and n over a column of texts as bytes; every task sends each of its words once or a few times."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()
        flush = lambda: pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])
        for batch in batches:
            for text in batch.column(0):
                counts.update(words_of(text.as_py()))
                if len(counts) > FLUSH_WORDS:
                    yield flush()
                    counts.clear()
        yield flush()

    return texts.mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _commonest(counts: DataFrame, size: int) -> tuple[list[bytes], np.ndarray]:
    """At most ``size`` words, all words whose count is above a limit, commonest first, and their counts.

    The limit comes from a histogram of counts (32 steps per doubling), so no task sorts candidates of all others."""
    step = F.floor(F.log2(F.col("n")) * 32).cast("int")
    limit, taken = 0, 0
    for bin_, words in sorted((tuple(r) for r in counts.groupBy(step.alias("bin")).agg(F.count("*")).collect()), reverse=True):
        taken += words
        if taken > size:
            limit = bin_ + 1
            break
    top = counts.where(step >= limit).toArrow()
    rows = sorted(zip(top.column(0).to_pylist(), top.column(1).to_pylist(), strict=True), key=lambda r: (-r[1], r[0]))
    return [bytes(w) for w, _ in rows], np.array([n for _, n in rows], np.float64)


@dataclass
class Lexicon:
    """The commonest words with their numbers, counts and endings, and the corpus totals."""

    numbers: dict[bytes, int]
    counts: np.ndarray
    tokens: int
    types: int
    ends: int

    def __post_init__(self):
        self.endings = np.array([OWN + ending(w) for w in self.numbers], np.int64)
        self.endings[: min(OWN, len(self.endings))] = np.arange(min(OWN, len(self.endings)))

    def encode(self, words: list[bytes]) -> tuple[np.ndarray, list[bytes]]:
        """A number per word (``LEXICON`` + ending beyond the lexicon), and the words beyond it."""
        get = self.numbers.get
        ids = np.array([get(w, -1) for w in words], np.int32)
        beyond = np.nonzero(ids < 0)[0]
        rest = [words[i] for i in beyond.tolist()]
        ids[beyond] = [LEXICON + ending(w) for w in rest]
        return ids, rest

    def units(self, ids: np.ndarray) -> np.ndarray:
        if not len(self.endings):
            return ids - LEXICON + OWN
        return np.where(ids < LEXICON, self.endings[np.minimum(ids, len(self.endings) - 1)], ids - LEXICON + OWN)


def _encoded(docs: DataFrame, lexicon) -> DataFrame:
    """row, doc_id, held, ids, rest: every text as numbers, and its words beyond the lexicon. Written once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = lexicon.value
        for batch in batches:
            for part in slices(batch, SLICE_BYTES, 3):
                found = [own.encode(words_of(t)) for t in part.column(3).to_pylist()]
                cuts = lambda sizes: pa.array(np.concatenate(([0], np.cumsum(sizes))), pa.int32())
                ids = pa.ListArray.from_arrays(cuts([len(i) for i, _ in found]), pa.array(np.concatenate([i for i, _ in found])))
                rest = pa.ListArray.from_arrays(cuts([len(r) for _, r in found]), pa.array([w for _, r in found for w in r], pa.binary()))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), part.column(2), ids, rest], names=["row", "doc_id", "held", "ids", "rest"])

    source = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held"), F.col("text").cast("binary").alias("text"))
    return written(source.mapInArrow(run, "row long, doc_id long, held boolean, ids array<int>, rest array<binary>"), "encoded")


def _parts(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[pa.RecordBatch]:
    """The batches in parts of at most ``PART_TOKENS`` tokens in a list column, ends included (one text at least)."""
    for batch in batches:
        lists = batch.column(column)
        after = lists.offsets.to_numpy()[1:].astype(np.int64) + np.arange(1, batch.num_rows + 1)
        start, done = 0, lists.offsets[0].as_py()
        while start < batch.num_rows:
            stop = max(start + 1, int(np.searchsorted(after, done + PART_TOKENS, "right")))
            yield batch.slice(start, stop - start)
            start, done = stop, after[stop - 1]


def _neighbours(batch: pa.RecordBatch, lexicon: Lexicon, column: int) -> tuple[np.ndarray, np.ndarray]:
    """Units of a batch's tokens with an end before the first text and after each; and where each text's tokens begin."""
    lists = batch.column(column)
    cuts = lists.offsets.to_numpy().astype(np.int64)
    units = lexicon.units(lists.values.to_numpy()[cuts[0] : cuts[-1]])
    cuts = cuts - cuts[0]
    return np.concatenate(([END_UNIT], np.insert(units, cuts[1:], END_UNIT))), cuts


def _profile(encoded: DataFrame, lexicon, classes: np.ndarray) -> np.ndarray:
    """Counts, units x (2 x classes + 1): the class after the unit, the class before it, and the unit itself after it."""
    shared = encoded.sparkSession.sparkContext.broadcast(classes)
    width = 2 * (CLASSES + 1) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, classes = lexicon.value, shared.value
        total = np.zeros(UNITS * width, np.int64)
        for batch in _parts(batches, 0):
            units, _ = _neighbours(batch, own, 0)
            a, b = units[:-1], units[1:]
            total += np.bincount(a * width + classes[b], minlength=len(total))
            total += np.bincount(b * width + CLASSES + 1 + classes[a], minlength=len(total))
            total += np.bincount((a * width + width - 1)[a == b], minlength=len(total))
        at = np.nonzero(total)[0]
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["cell", "n"])

    found = encoded.where(~F.col("held")).select("ids").mapInArrow(run, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(UNITS * width, np.int64)
    out[found.column(0).to_numpy()] = found.column(1).to_numpy()
    return out.reshape(UNITS, width)


def _bigrams(profile: np.ndarray, classes: np.ndarray) -> np.ndarray:
    out = np.zeros((CLASSES + 1, CLASSES + 1))
    np.add.at(out, classes, profile[:, : CLASSES + 1])
    return out


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-9))


def likelihood(bigrams: np.ndarray) -> np.ndarray:
    """The part of the class model's log-likelihood that depends on the classes, for one or several bigram tables."""
    return _xlogx(bigrams).sum((-1, -2)) - _xlogx(bigrams.sum(-1)).sum(-1) - _xlogx(bigrams.sum(-2)).sum(-1)


def exchange(profile: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """One sweep over the units, commonest first: each goes to the class of the highest likelihood."""
    classes, table_ = classes.copy(), _bigrams(profile, classes)
    each, old = np.arange(CLASSES), classes.copy()
    after, before, twice = profile[:, : CLASSES + 1].astype(float), profile[:, CLASSES + 1 : -1].astype(float), profile[:, -1].astype(float)
    size = after.sum(1)
    for u in np.argsort(-size, kind="stable").tolist():
        if u == END_UNIT or not size[u]:
            continue
        now = classes[u]
        right, left = after[u].copy(), before[u].copy()
        right[old[u]] -= twice[u]
        left[old[u]] -= twice[u]
        table_[now] -= right
        table_[:, now] -= left
        table_[now, now] -= twice[u]
        trial = np.repeat(np.maximum(table_, 0)[None], CLASSES, 0)
        trial[each, each] += right
        trial[each, :, each] += left
        trial[each, each, each] += twice[u]
        best = int(likelihood(trial).argmax())
        classes[u] = best
        table_[best] += right
        table_[:, best] += left
        table_[best, best] += twice[u]
    return classes


def first_classes() -> np.ndarray:
    classes = np.arange(UNITS) % CLASSES
    classes[END_UNIT] = CLASSES
    return classes


@dataclass
class Model:
    classes: np.ndarray
    step: np.ndarray  # log10 P(class | class before)
    place: np.ndarray  # log10 of each class's tokens, words and the place for unseen words


def _ending_types(counts: DataFrame, lexicon) -> np.ndarray:
    """Units' training tokens and distinct words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = lexicon.value
        total = np.zeros((UNITS, 2), np.int64)
        for batch in batches:
            words = batch.column(0).to_pylist()
            units = own.units(own.encode(words)[0])
            np.add.at(total[:, 0], units, batch.column(1).to_numpy())
            np.add.at(total[:, 1], units, 1)
        at = np.nonzero(total[:, 1])[0]
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at, 0]), pa.array(total[at, 1])], names=["unit", "n", "types"])

    out = np.zeros((UNITS, 2), np.int64)
    for unit, n, types in counts.select("word", "n").mapInArrow(run, "unit long, n long, types long").groupBy("unit").agg(F.sum("n"), F.sum("types")).collect():
        out[unit] = n, types
    return out


def train(encoded: DataFrame, counts: DataFrame, lexicon, rounds: int = ROUNDS) -> Model:
    classes, best = first_classes(), None
    for i in range(rounds + 1):
        profile = _profile(encoded, lexicon, classes)
        bigrams = _bigrams(profile, classes)
        value = float(likelihood(bigrams))
        if best is None or value > best[0]:
            best = value, classes, bigrams
        if i < rounds:
            classes = exchange(profile, classes)
    _, classes, bigrams = best
    frequency = (bigrams.sum(0) + 1) / (bigrams.sum() + CLASSES + 1)
    step = np.log10((bigrams + PRIOR * frequency) / (bigrams.sum(1, keepdims=True) + PRIOR))
    places = np.ones(CLASSES + 1)
    np.add.at(places, classes, _ending_types(counts, lexicon).sum(1))
    places[CLASSES] = 1
    return Model(classes, step, np.log10(places))


def scores(batches: Iterator[pa.RecordBatch], own: Lexicon, m: Model) -> Iterator[pa.RecordBatch]:
    """row, doc_id, held_out, n_tokens, n_known, base_score, score of encoded texts, words beyond the lexicon apart."""
    known = np.log10(np.append(own.counts, 0) + 1)
    for batch in _parts(batches, 3):
        units, cuts = _neighbours(batch, own, 3)
        ids = batch.column(3).values.to_numpy()[batch.column(3).offsets[0].as_py() :]
        classes = m.classes[units]
        size = np.diff(cuts) + 1
        starts = np.concatenate(([0], np.cumsum(size)))[:-1]
        moves = m.step[classes[:-1], classes[1:]] - m.place[classes[1:]]
        given = np.add.reduceat(moves, starts) if len(starts) else np.zeros(0)
        at = np.repeat(np.arange(len(size)), size - 1)
        listed = ids[: len(at)] < LEXICON
        common = np.bincount(at[listed], known[ids[: len(at)][listed]], len(size))
        n_known = np.bincount(at[listed], minlength=len(size)) + bool(own.ends)
        base = common + np.log10(own.ends + 1) - size * np.log10(own.tokens + own.types + 1)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array(size), pa.array(n_known.astype(np.int64)), pa.array(base), pa.array(given + common)],
                                         names=["row", "doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"])


def score(docs: DataFrame, lexicon_size: int = LEXICON, rounds: int = ROUNDS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row."""
    spark = docs.sparkSession
    training = docs.where(~held_out(F.col("doc_id")))
    counts = written(word_counts(training.select(F.col("text").cast("binary").alias("text"))), "counts")
    ends = training.count()
    totals = counts.agg(F.sum("n"), F.count("*")).first()
    words, numbers = _commonest(counts, min(lexicon_size, LEXICON))
    own = Lexicon({w: i for i, w in enumerate(words)}, numbers, (totals[0] or 0) + ends, totals[1] + bool(ends), ends)
    lexicon = spark.sparkContext.broadcast(own)
    encoded = _encoded(docs, lexicon)
    model = spark.sparkContext.broadcast(train(encoded, counts, lexicon, rounds))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return scores(batches, lexicon.value, model.value)

    listed = encoded.select("row", "doc_id", "held", "ids").mapInArrow(run, "row long, doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double")
    # Words beyond the lexicon are rare one by one; a text's repeats are one row, and their counts come by a join.
    rest = encoded.select("row", F.explode("rest").alias("word")).groupBy("row", "word").agg(F.count("*").alias("times"))
    rest = rest.join(counts, "word", "left").groupBy("row").agg(
        F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("rest_known"), F.sum(F.col("times") * F.log10(F.coalesce("n", F.lit(0)) + 1)).alias("rest_score"))
    more = F.coalesce("rest_score", F.lit(0.0))
    return listed.join(rest, "row", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("rest_known", F.lit(0))).alias("n_known"),
        F.lit(own.tokens).cast("long").alias("train_tokens"), (F.col("base_score") + more).alias("base_score"), (F.col("score") + more).alias("score"))


def op2_brown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents"))


