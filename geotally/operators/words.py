"""Word analyses: token streams, word frequencies without stopwords, top words of the busiest places."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import schema as S
from ..functions.fmt import escape
from ..functions.text import FIELD_SEP, tokens
from ..session import materialize
from .bloom import might_hold, word_filter
from .joins import drop_stopwords, keep_vocabulary
from .stats import count_by


def word_tokens(m: DataFrame, keep: Sequence[str] = (), longer_than: int = 2) -> DataFrame:
    """One row per kept token (``keep`` columns + ``word``): tokens longer than ``longer_than`` characters,
    measured before lower-casing, then lower-cased. Repeated words of a message stay repeated.

    Explode, filter and lower are plain expressions, so the whole chain stays in generated code (lambdas over the
    array would be interpreted per element).
    """
    toks = m.select(*keep, F.explode(tokens(S.TEXT)).alias("word"))
    return toks.where(F.length("word") > F.lit(longer_than)).select(*keep, F.lower("word").alias("word"))


def content_words(m: DataFrame, stopwords: DataFrame, keep: Sequence[str] = (), longer_than: int = 2) -> DataFrame:
    """``word_tokens`` without stopwords (anti join on the token; duplicates kept)."""
    return drop_stopwords(word_tokens(m, keep, longer_than), stopwords)


def word_counts(m: DataFrame, stopwords: DataFrame, country_code: str | None = "US", longer_than: int = 2,
                ordered: bool = True) -> DataFrame:
    """Frequency of each word (``word``, ``n``) in the messages of one country code, stopwords removed,
    ranked by frequency then word.

    Words are counted first, stopwords included, and the counted rows are joined: the partial aggregate collapses
    a hot word to one row per map task, so that no task ever holds its raw rows, however the join is planned.
    """
    sel = m if country_code is None else m.where(F.col(S.COUNTRY_CODE) == country_code)
    counts = word_tokens(sel, longer_than=longer_than).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    out = drop_stopwords(counts, stopwords)
    return out.orderBy(F.desc("n"), F.asc("word")) if ordered else out


# Words that the sketch of ``top_words`` follows, and that it may list.
TRACKED, LISTED = 1 << 16, 1 << 12


def top_words(m: DataFrame, stopwords: DataFrame, top: int = 10, country_code: str | None = "US", longer_than: int = 2,
              tracked: int = TRACKED, listed: int = LISTED) -> DataFrame:
    """The first ``top`` rows of ``word_counts`` without counting all words: ``word``, ``n``, ranked.

    Spark's frequent-items sketch lists words; they alone are counted exactly, in a second pass over the texts that lets only
    them pass (``bloom``). No shuffle carries the vocabulary. A word that is not listed occurs at most as often as the last
    one listed is estimated, or as the sketch's error allows (3.5 / its map's size of all tokens, twice). If the last of the
    ``top`` words occurs more often than that, the answer is proven; if not (flat counts), all words are counted.
    Runs one job to see which.
    """
    sel = m if country_code is None else m.where(F.col(S.COUNTRY_CODE) == country_code)
    toks = word_tokens(sel, longer_than=longer_than)
    # At most ``listed`` words and two numbers: one row, written once.
    sketch = materialize(toks.agg(F.expr(f"approx_top_k(word, {int(listed)}, {int(tracked)})").alias("found"), F.count(F.lit(1)).alias("n")), "top-words-sketch")
    likely = sketch.select(F.explode("found").alias("x")).select("x.item")
    counts = toks.where(might_hold(word_filter(likely), F.col("word"))).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    exact = drop_stopwords(keep_vocabulary(counts, likely), stopwords)
    best = materialize(exact.orderBy(F.desc("n"), F.asc("word")).limit(top), "top-words")
    last = F.when(F.size("found") >= listed, F.element_at("found", -1)["count"]).otherwise(0)
    size = 1 << (tracked * 4 // 3 - 1).bit_length()
    unseen = sketch.select(F.greatest(last, F.ceil(7 * F.col("n") / size)).alias("most")).first()["most"]
    found = best.agg(F.count(F.lit(1)).alias("rows"), F.min("n").alias("least")).first()
    if found["rows"] < top or found["least"] <= unseen:
        best = word_counts(m, stopwords, country_code, longer_than).limit(top)
    return best.orderBy(F.desc("n"), F.asc("word"))


def _place_filter(m: DataFrame, country_code: str | None, place_type: str | None) -> DataFrame:
    if country_code is not None:
        m = m.where(F.col(S.COUNTRY_CODE) == country_code)
    if place_type is not None:
        m = m.where(F.col(S.PLACE_TYPE) == place_type)
    return m


def top_groups(m: DataFrame, key: str = S.PLACE_NAME, top: int = 5, country_code: str | None = "US",
               place_type: str | None = "city") -> DataFrame:
    """The ``top`` keys with the most messages (``key``, ``place_n``); ties at the cut go to the lower key.

    Planned as TakeOrderedAndProject: each task keeps its own best ``top`` rows, so at most
    ``top`` x tasks rows reach the final merge.
    """
    counts = count_by(_place_filter(m, country_code, place_type), key, count_col="place_n", ordered=False)
    return counts.orderBy(F.desc("place_n"), F.asc(key)).limit(top)


def top_words_in_top_groups(m: DataFrame, stopwords: DataFrame, key: str = S.PLACE_NAME, top_groups_n: int = 5,
                            top_words_n: int = 10, country_code: str | None = "US",
                            place_type: str | None = "city", longer_than: int = 2,
                            messages_of: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """For the ``top_groups_n`` busiest keys, their ``top_words_n`` most frequent content words.

    Columns ``key, place_n, r, word, n``; exactly ``top_words_n`` rows per key when it has that many words,
    ordered by ``place_n`` descending, key, rank. Word ties are broken by the word.

    ``messages_of(top)`` may give the messages of the top keys (columns ``key``, ``place_n``) from a source that filters
    before its own joins; by default ``m`` is joined with them.

    Plan: the top keys are a bounded side (``top_groups_n`` rows), so they are broadcast to filter the messages
    without a shuffle. Words are counted per (key, word), so one hot key spreads over many reducers, and stopwords leave
    the counted rows. The
    ranking window runs with a partial group limit before its exchange (WindowGroupLimit), so each map task
    forwards at most ``top_words_n`` rows per key.
    """
    sel = _place_filter(m, country_code, place_type)
    top = top_groups(m, key, top_groups_n, country_code, place_type)
    # Broadcast is safe: ``top`` has at most top_groups_n rows by construction.
    msgs = (_place_filter(messages_of(top), country_code, place_type) if messages_of
            else sel.join(F.broadcast(top), key))
    toks = word_tokens(msgs, keep=(key, "place_n"), longer_than=longer_than)
    counts = drop_stopwords(toks.groupBy(key, "place_n", "word").agg(F.count(F.lit(1)).alias("n")), stopwords)
    w = Window.partitionBy(key).orderBy(F.desc("n"), F.asc("word"))
    ranked = counts.withColumn("r", F.row_number().over(w)).where(F.col("r") <= top_words_n)
    return ranked.select(key, "place_n", "r", "word", "n").orderBy(F.desc("place_n"), F.asc(key), F.asc("r"))


def wide_lines(top_words: DataFrame, key: str = S.PLACE_NAME) -> DataFrame:
    """One text line per key: ``key<TAB>w1<TAB>n1<TAB>...<TAB>wN<TAB>nN<TAB>`` (trailing tab), words in rank
    order; columns ``key, place_n, line`` (tabs and line breaks escaped) ordered by ``place_n`` descending. Each group holds at most N rows."""
    cells = F.transform(
        F.sort_array(F.collect_list(F.struct("r", "word", "n"))),
        lambda x: F.concat(escape(x["word"]), F.lit(FIELD_SEP), x["n"].cast("string"), F.lit(FIELD_SEP)))
    out = top_words.groupBy(key, "place_n").agg(
        F.concat(escape(F.col(key)), F.lit(FIELD_SEP), F.array_join(cells, "")).alias("line"))
    return out.orderBy(F.desc("place_n"), F.asc(key))
