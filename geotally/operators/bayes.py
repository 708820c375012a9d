"""Naive-Bayes place prediction from message text, fitted once and scored for many inputs in one job.

Model: ``T`` = number of messages, ``Tc`` = messages of place c, ``Tc,w`` = messages of place c containing word
w (one vote per message). Score of an input with words w1..wn (duplicates repeat):
``P(c) = (Tc / T) * (Tc,w1 / Tc) * ... * (Tc,wn / Tc)``, unsmoothed, so a place missing any input word scores 0.

Scaling plan (all exact, nothing is capped or sampled):

* inputs are numbered once (``prepare_inputs``): no join, group or window carries a text;
* a model for one batch is counted from the batch's words alone: a Bloom filter of them stands where tokens are read;
* the model's term table is first restricted to the input vocabulary (semi join);
* a place can only score above zero if it holds *every* distinct input word, so candidates are found through
  each input's rarest word (fewest places): at most that many places per input are ever examined;
* candidates are checked against the remaining words by an equi-join on (place, word);
* the product is folded in input-word order over an array bounded by the input length, so float equality of
  two scores means the same thing as in a sequential loop (ties are decided on it).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from itertools import count

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import schema as S
from ..functions.text import distinct_lower_tokens, lower_tokens
from ..session import materialize
from .bloom import might_hold, word_filter
from .joins import keep_vocabulary


@dataclass(frozen=True)
class PlaceModel:
    """``class_counts(place_name, tc)`` and ``term_counts(place_name, word, tcw)``; T is the sum of ``tc``.

    ``restricted`` marks a model fitted on a vocabulary (``fit_place_model(..., vocabulary=...)``): it may only
    score inputs whose words are all in that vocabulary, and scoring then skips its own vocabulary filter.
    """

    class_counts: DataFrame
    term_counts: DataFrame
    restricted: bool = False

    def total(self) -> Column:
        """T as a scalar subquery (evaluated once per query, no join needed)."""
        return self.class_counts.agg(F.sum("tc").alias("t")).scalar()

    def save(self, path: str, mode: str = "errorifexists") -> None:
        self.class_counts.write.mode(mode).parquet(f"{path.rstrip('/')}/class_counts")
        self.term_counts.write.mode(mode).parquet(f"{path.rstrip('/')}/term_counts")

    def materialize(self, name: str = "place-model") -> PlaceModel:
        """Write both tables once under the shared checkpoint folder and return the model reading them back.

        Scoring uses the term table several times with different column needs, so the optimizer cannot share
        one computation between the uses; a written model is fitted exactly once and cuts the lineage (a lost
        executor re-reads files instead of re-exploding all texts).
        """
        return PlaceModel(materialize(self.class_counts, f"{name}-class-counts"),
                          materialize(self.term_counts, f"{name}-term-counts"), self.restricted)

    @staticmethod
    def load(spark, path: str) -> PlaceModel:
        return PlaceModel(spark.read.parquet(f"{path.rstrip('/')}/class_counts"),
                          spark.read.parquet(f"{path.rstrip('/')}/term_counts"))

    def save_tables(self, name: str, buckets: int, path: str | None = None) -> None:
        """Store the model as the bucketed tables ``<name>_class_counts`` and ``<name>_term_counts``, in the warehouse or
        under ``path``.

        Terms are dealt into ``buckets`` by word, once. Every later batch joins them by word where they lie: only the
        batch's words are shuffled to the buckets, never the terms. Choose buckets so that one fits a task (about 128 MB).
        """
        for table, key in (("class_counts", S.PLACE_NAME), ("term_counts", "word")):
            # Dealt as the buckets are, so that each bucket is one file.
            rows = getattr(self, table).repartition(buckets, key)
            writer = rows.write.bucketBy(buckets, key).sortBy(key).format("parquet")
            if path:
                writer = writer.option("path", f"{path.rstrip('/')}/{table}")
            writer.saveAsTable(f"{name}_{table}")

    @staticmethod
    def from_tables(spark, name: str) -> PlaceModel:
        """The model of ``save_tables``."""
        return PlaceModel(spark.table(f"{name}_class_counts"), spark.table(f"{name}_term_counts"))


def votes(m: DataFrame, vocabulary: DataFrame | None = None, key: str = S.PLACE_NAME, text: str = S.TEXT) -> DataFrame:
    """``(place_name, word)``: one row per message and different word, and one with a NULL word per message.

    With ``vocabulary`` tokens meet its Bloom filter where they are read (``bloom``): nearly all rows left are votes for its
    words, so what is shuffled later follows the vocabulary's words and not the corpus'."""
    toks = F.coalesce(distinct_lower_tokens(text), F.array().cast("array<string>"))
    marked = F.concat(F.array(F.lit(None).cast("string")), toks)
    rows = m.select(F.col(key).alias(S.PLACE_NAME), F.explode(marked).alias("word"))
    if vocabulary is None:
        return rows
    return rows.where(F.col("word").isNull() | might_hold(word_filter(vocabulary), F.col("word")))


def place_counts(m: DataFrame, vocabulary: DataFrame | None = None, key: str = S.PLACE_NAME,
                 text: str = S.TEXT) -> DataFrame:
    """Both model counts from a single pass: ``(place_name, word, n)`` where ``word`` NULL carries ``Tc``.

    Every message also emits one NULL marker word, so one (place, word) aggregate yields ``Tc`` (the marker
    rows) and ``Tc,w`` (the word rows): one scan of the text and one shuffle, to which a task sends one row per
    place and word. With ``vocabulary`` (a written table, or one that is cheap to read again) other words leave before that
    shuffle (``votes``), and an exact semi join on the counted rows removes the few that the filter let pass: neither a
    frequent word nor the markers are ever shuffled as raw rows.
    """
    counts = votes(m, vocabulary, key, text).groupBy(S.PLACE_NAME, "word").agg(F.count(F.lit(1)).alias("n"))
    if vocabulary is None:
        return counts
    vocab = vocabulary.select(F.col(vocabulary.columns[0]).alias("word")).distinct().withColumn("__in", F.lit(True))
    return counts.join(vocab, "word", "left").where(F.col("__in") | F.col("word").isNull()).select(
        S.PLACE_NAME, "word", "n")


def fit_place_model(m: DataFrame, key: str = S.PLACE_NAME, text: str = S.TEXT,
                    vocabulary: DataFrame | None = None) -> PlaceModel:
    """Messages per place and, per (place, word), messages containing the lower-cased word (see ``place_counts``).

    With ``vocabulary`` (a one-column DataFrame of words, e.g. the words of a batch of inputs) the term table holds
    only those words. Scores of inputs whose words are all in it are identical to those of the full model.
    """
    return model_from_counts(place_counts(m, vocabulary, key, text), restricted=vocabulary is not None)


def model_from_counts(counts: DataFrame, restricted: bool = False) -> PlaceModel:
    """The two model tables from ``place_counts`` output (the marker split is a filter, pushed into a scan)."""
    class_counts = counts.where(F.col("word").isNull()).select(S.PLACE_NAME, F.col("n").alias("tc"))
    term_counts = counts.where(F.col("word").isNotNull()).select(S.PLACE_NAME, "word", F.col("n").alias("tcw"))
    return PlaceModel(class_counts, term_counts, restricted)


def fit_and_write_place_model(m: DataFrame, vocabulary: DataFrame | None = None, key: str = S.PLACE_NAME,
                              text: str = S.TEXT, name: str = "place-model") -> PlaceModel:
    """Fit in a single pass (``place_counts``) and write the counts once under the shared checkpoint folder;
    the returned model reads the written table (one scan of the text, one shuffle, one write)."""
    if vocabulary is not None:
        vocabulary = materialize(vocabulary.distinct(), f"{name}-vocabulary")
    counts = materialize(place_counts(m, vocabulary, key, text), name)
    return model_from_counts(counts, restricted=vocabulary is not None)


def input_vocabulary(inputs: DataFrame) -> DataFrame:
    """``word``: the distinct lower-cased tokens of all inputs."""
    return input_words(inputs).select("word").distinct()


def input_words(inputs: DataFrame) -> DataFrame:
    """``(input_id, pos, word)``: every lower-cased single-space token of every input, with its position."""
    return inputs.select("input_id", F.posexplode(lower_tokens("text")).alias("pos", "word"))


def restrict_terms(term_counts: DataFrame, inputs: DataFrame) -> DataFrame:
    """Model rows whose word occurs in some input (left semi join on the input vocabulary)."""
    return keep_vocabulary(term_counts, input_vocabulary(inputs), "word").select(S.PLACE_NAME, "word", "tcw")


# An input's score depends only on its lower-cased text: each different one is scored once, under this number.
BAG = "__bag"


@dataclass(frozen=True)
class InputBatch:
    """Inputs made ready for scoring: ``ids(input_id, __bag)`` and ``words(__bag, word, positions)``, written tables.

    ``__bag`` numbers the different lower-cased texts (NULL for a NULL text). Joins, groups and windows of the scorer carry the
    number; the text itself crosses one exchange, where the numbers are given out, and is read once, where it is split.
    """

    ids: DataFrame
    words: DataFrame

    def vocabulary(self) -> DataFrame:
        """``word``: the different words of all inputs."""
        return self.words.select("word").distinct()


def text_number(text: Column, seed: int) -> Column:
    """A number for a text; NULL for NULL."""
    return F.when(text.isNotNull(), F.xxhash64(F.lit(seed), text))


def prepare_inputs(inputs: DataFrame, hashed: Callable[[Column, int], Column] = text_number) -> InputBatch:
    """Number the different texts of ``inputs(input_id, text)`` and split each once.

    The number is a hash. Whether two texts share one is checked on the written texts; then another seed is tried.
    """
    low = F.lower("text")
    for seed in count():
        numbered = inputs.select("input_id", hashed(low, seed).alias(BAG), low.alias("__text"))
        # The one exchange that carries texts: equal ones are combined before it.
        texts = numbered.where(F.col(BAG).isNotNull()).groupBy(BAG).agg(F.min("__text").alias("__text"), F.max("__text").alias("__other"))
        texts = materialize(texts, "input-texts")
        if not texts.where(F.col("__text") != F.col("__other")).take(1):
            break
    words = texts.select(BAG, F.posexplode(lower_tokens("__text")).alias("pos", "word"))
    # Distinct words per text, with the positions at which each occurs (bounded by the text's length).
    words = words.groupBy(BAG, "word").agg(F.collect_list("pos").alias("positions"))
    return InputBatch(materialize(numbered.select("input_id", BAG), "input-ids"), materialize(words, "input-words"))


def _batch(inputs: DataFrame | InputBatch) -> InputBatch:
    return inputs if isinstance(inputs, InputBatch) else prepare_inputs(inputs)


def _score_bags(model: PlaceModel, batch: InputBatch, with_log: bool) -> DataFrame:
    """``(__bag, place_name, prob[, log_prob])`` for every different lower-cased text. The model's rows for the input
    words are written once; everything after reads those."""
    dw = batch.words
    terms = model.term_counts.select(S.PLACE_NAME, "word", "tcw")
    if not model.restricted:
        # The words are written before they are joined: they bring no partitioning of their own, so they are dealt as a
        # stored model's terms are, and those stay where they lie.
        words = materialize(batch.vocabulary(), "input-vocabulary")
        terms = materialize(keep_vocabulary(terms, words, "word"), "input-terms")

    # Per input word: in how many places it occurs. Pick each input's rarest word; an input with a word unknown
    # to the model has no candidate at all.
    spread = terms.groupBy("word").agg(F.count(F.lit(1)).alias("n_places"))
    per_input = dw.join(spread, "word", "left").groupBy(BAG).agg(
        F.count(F.lit(1)).alias("n_words"),
        F.count("n_places").alias("n_known"),
        F.min(F.struct("n_places", "word")).alias("rarest"))
    anchors = per_input.where(F.col("n_known") == F.col("n_words")).select(
        BAG, "n_words", F.col("rarest.word").alias("word"))
    candidates = anchors.join(terms, "word").select(BAG, "n_words", S.PLACE_NAME)

    # Check every distinct input word against each candidate place (equi-join on place and word).
    matched = (candidates.join(dw, BAG)
               .join(terms, [S.PLACE_NAME, "word"])
               .groupBy(BAG, S.PLACE_NAME, "n_words")
               .agg(F.count(F.lit(1)).alias("n_matched"),
                    F.flatten(F.collect_list(F.transform(
                        "positions", lambda p: F.struct(p.alias("pos"), F.col("tcw").alias("tcw"))))).alias("f")))
    full = matched.where(F.col("n_matched") == F.col("n_words")).join(model.class_counts, S.PLACE_NAME)

    factors = F.sort_array("f")  # by position: fold in input-word order
    fold = F.aggregate(factors, F.lit(1.0).cast("double"), lambda acc, x: acc * (x["tcw"] / F.col("tc")))
    prior = F.col("tc") / model.total()
    cols = [BAG, S.PLACE_NAME, (prior * fold).alias("prob")]
    if with_log:
        log_sum = F.aggregate(factors, F.lit(0.0).cast("double"),
                              lambda acc, x: acc + F.log(x["tcw"] / F.col("tc")))
        cols.append((F.log(prior) + log_sum).alias("log_prob"))
    return full.select(*cols)


def score_places(model: PlaceModel, inputs: DataFrame | InputBatch, with_log: bool = False) -> DataFrame:
    """``(input_id, place_name, prob)`` for every place holding all words of the input (``prob`` may still be
    0.0 through underflow on long inputs; ``with_log`` adds the finite ``log_prob``). Places missing a word
    score exactly 0 and are not listed."""
    batch = _batch(inputs)
    return batch.ids.join(_score_bags(model, batch, with_log), BAG).drop(BAG)


def predict_place(model: PlaceModel, inputs: DataFrame | InputBatch, rank_by: str = "prob") -> DataFrame:
    """``(input_id, place_name, prob)``: the best place per input; both of the first two (by name) when the top
    scores are exactly equal; one row with NULL place and prob when the best score is 0 or no place matches.

    ``rank_by='log_prob'`` ranks long inputs whose product underflows by the log score instead (then ``prob``
    may be 0.0 in the output). Places are ranked once per different text; equal inputs share the answer.
    """
    batch = _batch(inputs)
    scores = _score_bags(model, batch, with_log=(rank_by == "log_prob"))
    if rank_by == "log_prob":
        scores = scores.withColumn("__score", F.col("log_prob"))
        positive = F.col("__best").isNotNull()
    else:
        scores = scores.withColumn("__score", F.col("prob"))
        positive = F.col("__best") > F.lit(0.0)
    # Keep the two best per text: the row_number filter is planned as a partial group limit before the shuffle.
    w = Window.partitionBy(BAG).orderBy(F.desc("__score"), F.asc(S.PLACE_NAME))
    top2 = scores.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") <= 2)
    top2 = top2.withColumn("__best", F.max("__score").over(Window.partitionBy(BAG)))
    best = top2.where((F.col("__score") == F.col("__best")) & positive).select(BAG, S.PLACE_NAME, "prob")
    ids = batch.ids.distinct()
    return ids.join(best, BAG, "left").select("input_id", S.PLACE_NAME, "prob")
