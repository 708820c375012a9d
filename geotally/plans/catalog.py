"""Named queries over the test tables, each with an equivalent DuckDB SQL text.

Every query reads the whole ``documents``/``events``/``customer``/``nation`` tables through the message binding
(and ``benchmark`` for prediction inputs), so its work grows with the data. Column names are identical on both
sides; the SQL texts are written independently of the Spark code and serve as the correctness oracle.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema as S
from ..operators import bayes, stats, words
from ..session import ensure_checkpoint_dir
from ..sources.archives import read_archive_messages
from ..sources.sinks import tsv_lines, write_lines
from ..sources.tables import inputs_from_benchmark, messages_from_tables, read_table
from ..sources.tsv import (NULL_FIELD, SAMPLE_FIELDS, SAMPLE_FRACTION, parse_lines, read_numbered_lines, sample_limit,
                           stable_sample, write_parquet)
from ..sources.words import word_list

# Parameters of the registered queries (the message binding maps language codes to upper-case country codes).
COUNTRY_CODE = "EN"
PLACE_TYPE = "city"
MIN_COUNT = 40
CENTROID_DIGITS = 6
TOP_PLACES = 5
TOP_WORDS = 10
SAMPLE_SEED = 5
MODEL_BUCKETS = 8
# The stopword list used by the registered queries.
STOPWORDS = ("the", "and", "that", "for", "was", "with", "this", "are", "from")

Query = Callable[[SparkSession, str], DataFrame]


def _m(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messages_from_tables(spark, sf_dir)


def _measured(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messages_from_tables(spark, sf_dir, measures=True)


def _top_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return words.top_words_in_top_groups(
        _m(spark, sf_dir), _stopwords(spark), S.PLACE_NAME, TOP_PLACES, TOP_WORDS, COUNTRY_CODE, PLACE_TYPE,
        messages_of=lambda top: messages_from_tables(spark, sf_dir, top=top))


def _round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every message as an escaped line, and the line read back."""
    lines = _m(spark, sf_dir)
    return parse_lines(lines.select(tsv_lines(lines, null=NULL_FIELD).alias("value")), "null", escaped=True)


def _stopwords(spark: SparkSession) -> DataFrame:
    return word_list(spark, STOPWORDS)


def _model(spark: SparkSession, sf_dir: str) -> bayes.PlaceModel:
    return bayes.fit_place_model(_m(spark, sf_dir))


def _batch(spark: SparkSession, sf_dir: str) -> bayes.InputBatch:
    return bayes.prepare_inputs(inputs_from_benchmark(spark, sf_dir))


def _batch_model(spark: SparkSession, sf_dir: str, batch: bayes.InputBatch) -> bayes.PlaceModel:
    """Model fitted for one scoring batch: other words leave where they are read, before anything is shuffled."""
    return bayes.fit_and_write_place_model(_m(spark, sf_dir), vocabulary=batch.vocabulary())


def _score_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    batch = _batch(spark, sf_dir)
    return bayes.score_places(_batch_model(spark, sf_dir, batch), batch)


def _predict_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    batch = _batch(spark, sf_dir)
    return bayes.predict_place(_batch_model(spark, sf_dir, batch), batch)


def _predict_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = bayes.fit_and_write_place_model(_m(spark, sf_dir), name="full-place-model")
    return bayes.predict_place(model, _batch(spark, sf_dir))


def _predict_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A model stored in bucketed tables, loaded and asked: its terms are not shuffled again."""
    name = f"place_model_{uuid.uuid4().hex}"
    fitted = bayes.fit_and_write_place_model(_m(spark, sf_dir), name="full-place-model")
    fitted.save_tables(name, MODEL_BUCKETS, f"{ensure_checkpoint_dir(spark).rstrip('/')}/tables/{name}")
    return bayes.predict_place(bayes.PlaceModel.from_tables(spark, name), _batch(spark, sf_dir))


def _shared(spark: SparkSession, what: str) -> str:
    """A new folder for a query's files, in the shared folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/tables/{what}-{uuid.uuid4().hex}"


def _parts_by_place(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The profile merged from the parts of each country and place."""
    return stats.profile_from_parts(stats.profile_parts(_measured(spark, sf_dir), (S.COUNTRY_CODE, S.PLACE_NAME)))


def _bounds_from_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every message goes into a Parquet copy; its footers give the bounds."""
    path = _shared(spark, "message-copy")
    write_parquet(_m(spark, sf_dir).select(S.LATITUDE, S.LONGITUDE), path)
    return stats.bounds_from_files(spark, path)


def _archive_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every message as a line of gzip archives, and the archives' parts read back."""
    path = _shared(spark, "archives")
    lines = _m(spark, sf_dir)
    lines.select(tsv_lines(lines, null=NULL_FIELD).alias("value")).write.option("compression", "gzip").text(path)
    return read_archive_messages(spark, f"{path}/part-*", "null", r"(part-\d+)", escaped=True)


def _numbered_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A line per document, written in order of doc_id and numbered as read."""
    path = _shared(spark, "lines")
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    write_lines(docs, F.concat_ws("|", *docs.columns), path, order_by=["doc_id"])
    return read_numbered_lines(spark, path).select("number", "value")


def queries() -> dict[str, Query]:
    return {
        "messages": lambda spark, d: _m(spark, d),
        "profile": lambda spark, d: stats.profile(_measured(spark, d)),
        "profile_report": lambda spark, d: stats.profile_report(_measured(spark, d)),
        "distinct_values": lambda spark, d: stats.distinct_values(_m(spark, d)),
        "bounds": lambda spark, d: stats.bounds(_m(spark, d)),
        "profile_from_parts": _parts_by_place,
        "bounds_from_files": _bounds_from_files,
        "archive_round_trip": _archive_round_trip,
        "numbered_lines": _numbered_lines,
        "text_lengths": lambda spark, d: stats.text_lengths(_measured(spark, d)),
        "count_by_country": lambda spark, d: stats.count_by(_m(spark, d), S.COUNTRY_NAME),
        "centroid_by_country": lambda spark, d: stats.centroid_by(
            _m(spark, d), S.COUNTRY_NAME, min_count=MIN_COUNT, digits=CENTROID_DIGITS),
        "local_hours": lambda spark, d: stats.local_hours(_m(spark, d)),
        "count_by_country_hour": lambda spark, d: stats.count_by_local_hour(_m(spark, d), S.COUNTRY_NAME),
        "tsv_round_trip": _round_trip,
        "peak_local_hour": lambda spark, d: stats.peak_local_hour(_m(spark, d), S.COUNTRY_NAME),
        "count_by_city": lambda spark, d: stats.filtered_count_by(
            _m(spark, d), S.PLACE_NAME, COUNTRY_CODE, PLACE_TYPE),
        "word_tokens": lambda spark, d: words.word_tokens(
            _m(spark, d).where(f"{S.COUNTRY_CODE} = '{COUNTRY_CODE}'")),
        "stopword_anti": lambda spark, d: words.content_words(
            _m(spark, d).where(f"{S.COUNTRY_CODE} = '{COUNTRY_CODE}'"), _stopwords(spark)),
        "word_counts": lambda spark, d: words.word_counts(
            _m(spark, d), _stopwords(spark), country_code=COUNTRY_CODE),
        "top_words": lambda spark, d: words.top_words(
            _m(spark, d), _stopwords(spark), TOP_WORDS, COUNTRY_CODE),
        "top_places": lambda spark, d: words.top_groups(
            _m(spark, d), S.PLACE_NAME, TOP_PLACES, COUNTRY_CODE, PLACE_TYPE),
        "top_words_in_top_places": _top_words,
        "top_words_lines": lambda spark, d: words.wide_lines(_top_words(spark, d)),
        "input_words": lambda spark, d: bayes.input_words(inputs_from_benchmark(spark, d)),
        "class_counts": lambda spark, d: _model(spark, d).class_counts,
        "term_counts": lambda spark, d: _model(spark, d).term_counts,
        "vocabulary_semi": lambda spark, d: bayes.restrict_terms(
            _model(spark, d).term_counts, inputs_from_benchmark(spark, d)),
        "score_places": _score_batch,
        "predict_place": _predict_batch,
        "predict_place_full_model": _predict_full,
        "predict_place_stored_model": _predict_stored,
        "sample": lambda spark, d: _m(spark, d).sample(False, 0.01, seed=5),
        "sample_stable": lambda spark, d: stable_sample(_m(spark, d), SAMPLE_FRACTION, SAMPLE_SEED),
    }


# --------------------------------------------------------------------------------------------------------------
# DuckDB oracle texts
# --------------------------------------------------------------------------------------------------------------

MESSAGES_CTE = """
messages AS (
  SELECT epoch_us(e.ts) // 1000 AS utc_time,
         n.n_name AS country_name,
         upper(d.lang) AS country_code,
         CASE WHEN e.event_type = 'error' THEN 'admin' ELSE 'city' END AS place_type,
         d.source AS place_name,
         d.lang AS language,
         c.c_mktsegment AS user_screen_name,
         c.c_name AS username,
         CAST((n.n_nationkey - 12) * 3600 AS INTEGER) AS timezone_offset,
         CAST(d.doc_id % 500 AS INTEGER) AS number_of_friends,
         d.text AS tweet_text,
         c.c_acctbal / 120 AS latitude,
         e.value AS longitude
  FROM documents d
  JOIN events e ON d.doc_id = e.event_id
  JOIN customer c ON e.user_id = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
)"""

_SW = ", ".join(f"('{w}')" for w in STOPWORDS)
STOPWORDS_CTE = f"stopwords(word) AS (VALUES {_SW})"

# A text field as the sinks write it.
ESCAPED = r"replace(replace(replace(replace({}, '\', '\\'), chr(9), '\t'), chr(10), '\n'), chr(13), '\r')"

HOUR_SQL = "CAST((((utc_time // 1000 + timezone_offset) % 86400 + 86400) % 86400) // 3600 AS INTEGER)"

# Tokens longer than two characters (length before lower-casing), lower-cased, of one country's messages.
WORD_TOKENS_CTE = f"""
word_tokens AS (
  SELECT place_name, lower(w) AS word
  FROM (SELECT place_name, unnest(string_split(tweet_text, ' ')) AS w
        FROM messages WHERE country_code = '{COUNTRY_CODE}')
  WHERE length(w) > 2
)"""

TOP_PLACES_CTE = f"""
place_counts AS (
  SELECT place_name, count(*) AS place_n FROM messages
  WHERE country_code = '{COUNTRY_CODE}' AND place_type = '{PLACE_TYPE}'
  GROUP BY place_name
),
top_places AS (
  SELECT place_name, place_n FROM place_counts ORDER BY place_n DESC, place_name LIMIT {TOP_PLACES}
)"""

TOP_WORDS_CTE = f"""
top_words AS (
  SELECT place_name, place_n, r, word, n FROM (
    SELECT t.place_name, t.place_n, w.word, CAST(count(*) AS BIGINT) AS n,
           CAST(row_number() OVER (PARTITION BY t.place_name ORDER BY count(*) DESC, w.word) AS INTEGER) AS r
    FROM top_places t
    JOIN (SELECT place_name, lower(w) AS word
          FROM (SELECT place_name, unnest(string_split(tweet_text, ' ')) AS w
                FROM messages WHERE country_code = '{COUNTRY_CODE}' AND place_type = '{PLACE_TYPE}')
          WHERE length(w) > 2) w ON w.place_name = t.place_name
    WHERE w.word NOT IN (SELECT word FROM stopwords)
    GROUP BY t.place_name, t.place_n, w.word
  ) WHERE r <= {TOP_WORDS}
)"""

MODEL_CTE = """
total AS (SELECT count(*) AS total_n FROM messages),
class_counts AS (SELECT place_name, CAST(count(*) AS BIGINT) AS tc FROM messages GROUP BY place_name),
term_counts AS (
  SELECT place_name, word, CAST(count(*) AS BIGINT) AS tcw
  FROM (SELECT place_name, unnest(list_distinct(string_split(lower(tweet_text), ' '))) AS word FROM messages)
  GROUP BY place_name, word
)"""

INPUTS_CTE = """
inputs AS (SELECT CAST(item_id AS BIGINT) AS input_id, text FROM benchmark),
input_words AS (
  SELECT input_id, unnest(range(0, len(ws))) AS pos, unnest(ws) AS word
  FROM (SELECT input_id, string_split(lower(text), ' ') AS ws FROM inputs)
)"""

# A place scores above zero only if it holds every distinct word of the input.
SCORES_CTE = """
input_sizes AS (SELECT input_id, count(DISTINCT word) AS n_words FROM input_words GROUP BY input_id),
matched_places AS (
  SELECT d.input_id, tc.place_name
  FROM (SELECT DISTINCT input_id, word FROM input_words) d
  JOIN term_counts tc ON tc.word = d.word
  JOIN input_sizes s ON s.input_id = d.input_id
  GROUP BY d.input_id, tc.place_name, s.n_words
  HAVING count(*) = s.n_words
),
scores AS (
  SELECT i.input_id, mp.place_name,
         (c.tc / (SELECT total_n FROM total)) * product(tc.tcw / c.tc ORDER BY i.pos) AS prob
  FROM input_words i
  JOIN matched_places mp ON mp.input_id = i.input_id
  JOIN term_counts tc ON tc.place_name = mp.place_name AND tc.word = i.word
  JOIN class_counts c ON c.place_name = mp.place_name
  GROUP BY i.input_id, mp.place_name, c.tc
)"""

PREDICT_SQL = """
SELECT i.input_id, ch.place_name, ch.prob
FROM (SELECT DISTINCT input_id FROM inputs) i
LEFT JOIN (
  SELECT input_id, place_name, prob FROM (
    SELECT input_id, place_name, prob,
           row_number() OVER (PARTITION BY input_id ORDER BY prob DESC, place_name) AS rn,
           max(prob) OVER (PARTITION BY input_id) AS best
    FROM scores)
  WHERE rn <= 2 AND prob = best AND best > 0) ch ON ch.input_id = i.input_id"""


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes) + "\n"


def oracle_sql() -> dict[str, str]:
    w = _with
    return {
        "messages": w(MESSAGES_CTE) + "SELECT * FROM messages",
        # Few enough different values that the sketches' estimates are exact.
        **dict.fromkeys(("profile", "profile_from_parts"), w(MESSAGES_CTE) + """
SELECT count(*) AS n_messages,
       count(DISTINCT username) AS n_distinct_username,
       count(DISTINCT country_name) AS n_distinct_country_name,
       count(DISTINCT place_name) AS n_distinct_place_name,
       count(DISTINCT language) AS n_distinct_language,
       min(latitude) AS min_latitude, max(latitude) AS max_latitude,
       min(longitude) AS min_longitude, max(longitude) AS max_longitude,
       avg(length(tweet_text)) AS avg_chars,
       avg(len(string_split(tweet_text, ' '))) AS avg_words
FROM messages"""),
        "profile_report": w(MESSAGES_CTE) + """,
p AS (
  SELECT count(*) AS a, count(DISTINCT username) AS b, count(DISTINCT country_name) AS c,
         count(DISTINCT place_name) AS d, count(DISTINCT language) AS e,
         min(latitude) AS f, max(latitude) AS g, min(longitude) AS h, max(longitude) AS i,
         avg(length(tweet_text)) AS j, avg(len(string_split(tweet_text, ' '))) AS k
  FROM messages)
SELECT * FROM (
  SELECT 1 AS pos, 'Number of tweets' AS label, CAST(a AS VARCHAR) AS value FROM p UNION ALL
  SELECT 2, 'Number of distinct usernames', CAST(b AS VARCHAR) FROM p UNION ALL
  SELECT 3, 'Number of distinct countries', CAST(c AS VARCHAR) FROM p UNION ALL
  SELECT 4, 'Number of distinct place names', CAST(d AS VARCHAR) FROM p UNION ALL
  SELECT 5, 'Number of distinct languages used', CAST(e AS VARCHAR) FROM p UNION ALL
  SELECT 6, 'Minimum latitude', printf('%.3f', f) FROM p UNION ALL
  SELECT 7, 'Maximum latitude', printf('%.3f', g) FROM p UNION ALL
  SELECT 8, 'Minimum longitude', printf('%.3f', h) FROM p UNION ALL
  SELECT 9, 'Maximum longitude', printf('%.3f', i) FROM p UNION ALL
  SELECT 10, 'Average tweet length in characters', printf('%.2f', j) FROM p UNION ALL
  SELECT 11, 'The average length of a tweet text is', printf('%.2f', k) FROM p)""",
        "distinct_values": w(MESSAGES_CTE) + """
SELECT count(DISTINCT username) AS n_distinct_username,
       count(DISTINCT country_name) AS n_distinct_country_name,
       count(DISTINCT place_name) AS n_distinct_place_name,
       count(DISTINCT language) AS n_distinct_language
FROM messages""",
        "bounds": w(MESSAGES_CTE) + """
SELECT min(latitude) AS min_latitude, max(latitude) AS max_latitude,
       min(longitude) AS min_longitude, max(longitude) AS max_longitude
FROM messages""",
        "bounds_from_files": w(MESSAGES_CTE) + """
SELECT count(*) AS n_messages, min(latitude) AS min_latitude, max(latitude) AS max_latitude,
       min(longitude) AS min_longitude, max(longitude) AS max_longitude
FROM messages""",
        "archive_round_trip": w(MESSAGES_CTE) + "SELECT * FROM messages",
        "numbered_lines": """
SELECT row_number() OVER (ORDER BY doc_id) - 1 AS number, concat_ws('|', doc_id, lang, source) AS value FROM documents""",
        "text_lengths": w(MESSAGES_CTE) + """
SELECT avg(length(tweet_text)) AS avg_chars, avg(len(string_split(tweet_text, ' '))) AS avg_words
FROM messages""",
        "count_by_country": w(MESSAGES_CTE) + """
SELECT country_name, count(*) AS n FROM messages GROUP BY country_name ORDER BY n DESC, country_name""",
        "centroid_by_country": w(MESSAGES_CTE) + f"""
SELECT country_name, count(*) AS n,
       round(avg(latitude), {CENTROID_DIGITS}) AS latitude,
       round(avg(longitude), {CENTROID_DIGITS}) AS longitude
FROM messages GROUP BY country_name HAVING count(*) > {MIN_COUNT}""",
        "local_hours": w(MESSAGES_CTE) + f"""
SELECT utc_time, timezone_offset, {HOUR_SQL} AS hour FROM messages""",
        "count_by_country_hour": w(MESSAGES_CTE) + f"""
SELECT country_name, {HOUR_SQL} AS hour, count(*) AS n FROM messages GROUP BY ALL""",
        "tsv_round_trip": w(MESSAGES_CTE) + "SELECT * FROM messages",
        "sample_stable": w(MESSAGES_CTE) + f"""
SELECT * FROM messages
WHERE substr(md5(concat_ws('|', '{SAMPLE_SEED}', {", ".join(SAMPLE_FIELDS)})), 1, 15) < '{sample_limit(SAMPLE_FRACTION)}'""",
        "peak_local_hour": w(MESSAGES_CTE) + f""",
hourly AS (SELECT country_name, {HOUR_SQL} AS hour, count(*) AS n FROM messages GROUP BY ALL)
SELECT country_name, hour, n FROM (
  SELECT *, row_number() OVER (PARTITION BY country_name ORDER BY n DESC, hour) AS r FROM hourly)
WHERE r = 1""",
        "count_by_city": w(MESSAGES_CTE) + f"""
SELECT place_name, count(*) AS n FROM messages
WHERE country_code = '{COUNTRY_CODE}' AND place_type = '{PLACE_TYPE}'
GROUP BY place_name ORDER BY n DESC, place_name""",
        "word_tokens": w(MESSAGES_CTE, WORD_TOKENS_CTE) + "SELECT word FROM word_tokens",
        "stopword_anti": w(MESSAGES_CTE, STOPWORDS_CTE, WORD_TOKENS_CTE) + """
SELECT word FROM word_tokens WHERE word NOT IN (SELECT word FROM stopwords)""",
        "word_counts": w(MESSAGES_CTE, STOPWORDS_CTE, WORD_TOKENS_CTE) + """
SELECT word, count(*) AS n FROM word_tokens
WHERE word NOT IN (SELECT word FROM stopwords)
GROUP BY word ORDER BY n DESC, word""",
        "top_words": w(MESSAGES_CTE, STOPWORDS_CTE, WORD_TOKENS_CTE) + f"""
SELECT word, count(*) AS n FROM word_tokens
WHERE word NOT IN (SELECT word FROM stopwords)
GROUP BY word ORDER BY n DESC, word LIMIT {TOP_WORDS}""",
        "top_places": w(MESSAGES_CTE, TOP_PLACES_CTE) + "SELECT place_name, place_n FROM top_places",
        "top_words_in_top_places": w(MESSAGES_CTE, STOPWORDS_CTE, TOP_PLACES_CTE, TOP_WORDS_CTE) + """
SELECT place_name, place_n, r, word, n FROM top_words""",
        "top_words_lines": w(MESSAGES_CTE, STOPWORDS_CTE, TOP_PLACES_CTE, TOP_WORDS_CTE) + f"""
SELECT place_name, place_n,
       {ESCAPED.format("place_name")} || chr(9) ||
       string_agg({ESCAPED.format("word")} || chr(9) || CAST(n AS VARCHAR) || chr(9), '' ORDER BY r) AS line
FROM top_words GROUP BY place_name, place_n""",
        "input_words": w(INPUTS_CTE) + "SELECT input_id, CAST(pos AS INTEGER) AS pos, word FROM input_words",
        "class_counts": w(MESSAGES_CTE, MODEL_CTE) + "SELECT place_name, tc FROM class_counts",
        "term_counts": w(MESSAGES_CTE, MODEL_CTE) + "SELECT place_name, word, tcw FROM term_counts",
        "vocabulary_semi": w(MESSAGES_CTE, MODEL_CTE, INPUTS_CTE) + """
SELECT place_name, word, tcw FROM term_counts WHERE word IN (SELECT word FROM input_words)""",
        "score_places": w(MESSAGES_CTE, MODEL_CTE, INPUTS_CTE, SCORES_CTE)
        + "SELECT input_id, place_name, prob FROM scores",
        **dict.fromkeys(("predict_place", "predict_place_full_model", "predict_place_stored_model"),
                        w(MESSAGES_CTE, MODEL_CTE, INPUTS_CTE, SCORES_CTE) + PREDICT_SQL),
    }
