"""Descriptive analyses of the message table: profile, ranked counts, centroids, peak local hour.

Every analysis is one declarative plan: scan (pruned to the used columns) -> partial aggregate on the mappers ->
one hash exchange on the key -> final aggregate, with a range exchange only where a global order is asked for.
A key holding a third of all rows costs nothing extra: partial aggregation collapses it before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema as S
from ..functions.fmt import fixed
from ..functions.text import char_length, word_count
from ..functions.time import local_hour

DISTINCT_COLUMNS = (S.USERNAME, S.COUNTRY_NAME, S.PLACE_NAME, S.LANGUAGE)


def _distinct(col: str, approx: bool, rsd: float) -> Column:
    return F.approx_count_distinct(col, rsd) if approx else F.count_distinct(F.col(col))


def distinct_count_columns(columns: Sequence[str] = DISTINCT_COLUMNS, approx: bool = False,
                           rsd: float = 0.01) -> list[Column]:
    """``n_distinct_<col>`` per column. Exact by default (''-values count, NULLs do not).

    Exact distinct counts are planned as one Expand + two-level aggregate (one copy of each row per distinct
    column); ``approx=True`` switches to HyperLogLog++ sketches merged map-side, for very large inputs.
    """
    return [_distinct(c, approx, rsd).alias(f"n_distinct_{c}") for c in columns]


def bound_columns() -> list[Column]:
    return [
        F.min(S.LATITUDE).alias("min_latitude"), F.max(S.LATITUDE).alias("max_latitude"),
        F.min(S.LONGITUDE).alias("min_longitude"), F.max(S.LONGITUDE).alias("max_longitude"),
    ]


def text_length_columns(m: DataFrame) -> list[Column]:
    """Averages over ``text_chars`` and ``text_words`` if the source has measured them, else over the texts."""
    measured = {S.TEXT_CHARS, S.TEXT_WORDS} <= set(m.columns)
    return [
        F.avg(F.col(S.TEXT_CHARS) if measured else char_length(S.TEXT)).alias("avg_chars"),
        F.avg(F.col(S.TEXT_WORDS) if measured else word_count(S.TEXT)).alias("avg_words"),
    ]


def distinct_values(m: DataFrame, columns: Sequence[str] = DISTINCT_COLUMNS, approx: bool = False) -> DataFrame:
    """One row: number of distinct values of each column."""
    return m.agg(*distinct_count_columns(columns, approx))


def bounds(m: DataFrame) -> DataFrame:
    """One row: min/max latitude and longitude."""
    return m.agg(*bound_columns())


def text_lengths(m: DataFrame) -> DataFrame:
    """One row: average text length in characters and in single-space words."""
    return m.agg(*text_length_columns(m))


def profile(m: DataFrame, approx: bool = False) -> DataFrame:
    """One row with all eleven measures of the data set, computed in a single scan and aggregate."""
    return m.agg(F.count(F.lit(1)).alias("n_messages"), *distinct_count_columns(approx=approx),
                 *bound_columns(), *text_length_columns(m))


# Report labels of the eleven profile measures, in report order.
PROFILE_LABELS = (
    "Number of tweets",
    "Number of distinct usernames",
    "Number of distinct countries",
    "Number of distinct place names",
    "Number of distinct languages used",
    "Minimum latitude",
    "Maximum latitude",
    "Minimum longitude",
    "Maximum longitude",
    "Average tweet length in characters",
    "The average length of a tweet text is",
)


def profile_report(m: DataFrame, approx: bool = False) -> DataFrame:
    """The profile as ``(pos, label, value)`` report rows: counts as integers, coordinates with 3 decimals,
    averages with 2 decimals (rounded half-even on the binary value)."""
    p = profile(m, approx)
    values = [
        F.col("n_messages").cast("string"),
        *[F.col(f"n_distinct_{c}").cast("string") for c in DISTINCT_COLUMNS],
        fixed("min_latitude", 3), fixed("max_latitude", 3),
        fixed("min_longitude", 3), fixed("max_longitude", 3),
        fixed("avg_chars", 2), fixed("avg_words", 2),
    ]
    rows = [F.struct(F.lit(i + 1).alias("pos"), F.lit(label).alias("label"), v.alias("value"))
            for i, (label, v) in enumerate(zip(PROFILE_LABELS, values))]
    return p.select(F.inline(F.array(*rows)))


def count_by(m: DataFrame, keys: str | Sequence[str], count_col: str = "n", ordered: bool = True) -> DataFrame:
    """Messages per key, ranked by count (descending) with ties broken by the key (ascending)."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    out = m.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_col))
    return out.orderBy(F.desc(count_col), *[F.asc(k) for k in keys]) if ordered else out


def filtered_count_by(m: DataFrame, key: str = S.PLACE_NAME, country_code: str = "US",
                      place_type: str = "city", ordered: bool = True) -> DataFrame:
    """Ranked message counts per place among messages of one country code and place type."""
    sel = m.where((F.col(S.COUNTRY_CODE) == country_code) & (F.col(S.PLACE_TYPE) == place_type))
    return count_by(sel, key, ordered=ordered)


def centroid_by(m: DataFrame, key: str = S.COUNTRY_NAME, min_count: int = 10,
                digits: int | None = None) -> DataFrame:
    """Mean latitude/longitude per key, for keys with strictly more than ``min_count`` messages.

    One pass: count and both means come from the same partial/final aggregate; the support filter is a HAVING
    on the aggregated rows. ``digits`` optionally rounds the means (floating sums depend on summation order).
    """
    agg = m.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.avg(S.LATITUDE).alias(S.LATITUDE),
                             F.avg(S.LONGITUDE).alias(S.LONGITUDE))
    agg = agg.where(F.col("n") > F.lit(min_count))
    if digits is not None:
        agg = agg.select(key, "n", F.round(S.LATITUDE, digits).alias(S.LATITUDE),
                         F.round(S.LONGITUDE, digits).alias(S.LONGITUDE))
    return agg


def local_hours(m: DataFrame) -> DataFrame:
    """Per message: its local hour (0-23) from UTC milliseconds and the zone offset in seconds."""
    return m.select(S.UTC_TIME, S.TIMEZONE_OFFSET,
                    local_hour(S.UTC_TIME, S.TIMEZONE_OFFSET).alias("hour"))


def count_by_local_hour(m: DataFrame, key: str = S.COUNTRY_NAME) -> DataFrame:
    """Messages per (key, local hour); messages without a time count under a NULL hour."""
    hour = local_hour(S.UTC_TIME, S.TIMEZONE_OFFSET)
    return m.select(key, hour.alias("hour")).groupBy(key, "hour").agg(F.count(F.lit(1)).alias("n"))


def peak_local_hour(m: DataFrame, key: str = S.COUNTRY_NAME) -> DataFrame:
    """Per key, the local hour with the most messages and that count; ties go to the lower hour. A key none of whose
    messages has a time gets a NULL hour and a count of 0.

    One aggregate with 24 conditional counts per key: the mappers pre-aggregate to 24 numbers per key, one hash
    exchange on the key, and the arg-max is an array expression on the final row. No second shuffle and no
    per-key sort.
    """
    hour = local_hour(S.UTC_TIME, S.TIMEZONE_OFFSET)
    per_hour = m.select(key, hour.alias("hour")).groupBy(key).agg(
        F.array(*[F.count_if(F.col("hour") == F.lit(h)) for h in range(24)]).alias("by_hour"))
    best = F.array_max("by_hour")
    return per_hour.select(
        key,
        F.when(best > 0, F.array_position("by_hour", best) - 1).cast("int").alias("hour"),
        best.alias("n"),
    )


# -- profiles that can be merged -------------------------------------------------------------------------------

# Log2 of a sketch's registers: a standard error of 0.8 % in at most 16 KB per column.
SKETCH_LG_K = 14


def profile_parts(m: DataFrame, keys: Sequence[str] = (), lg_k: int = SKETCH_LG_K) -> DataFrame:
    """Per ``keys`` (none: one row) everything that a profile is made of, in a form that can be stored and merged: counts, sums,
    bounds, and a HyperLogLog sketch (built in) for each distinct count. New files are profiled alone and merged with
    what is stored; nothing old is read again."""
    measured = {S.TEXT_CHARS, S.TEXT_WORDS} <= set(m.columns)
    chars, words = (F.col(S.TEXT_CHARS), F.col(S.TEXT_WORDS)) if measured else (char_length(S.TEXT), word_count(S.TEXT))
    return m.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_messages"),
        *[F.hll_sketch_agg(c, F.lit(lg_k)).alias(f"sketch_{c}") for c in DISTINCT_COLUMNS], *bound_columns(),
        F.sum(chars).alias("sum_chars"), F.sum(words).alias("sum_words"), F.count(chars).alias("n_texts"))


def merge_profile_parts(parts: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Parts (of any sources, days or keys) merged to one row per ``keys``."""
    bounds_ = [f(c).alias(c) for f, cs in ((F.min, ("min_latitude", "min_longitude")), (F.max, ("max_latitude", "max_longitude"))) for c in cs]
    return parts.groupBy(*keys).agg(
        F.sum("n_messages").alias("n_messages"), *[F.hll_union_agg(f"sketch_{c}").alias(f"sketch_{c}") for c in DISTINCT_COLUMNS], *bounds_,
        *[F.sum(c).alias(c) for c in ("sum_chars", "sum_words", "n_texts")])


def profile_from_parts(parts: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """The columns of ``profile`` from stored parts; distinct counts are the sketches' estimates, all else is exact."""
    p = merge_profile_parts(parts, keys)
    average = lambda total: F.when(F.col("n_texts") > 0, F.col(total) / F.col("n_texts"))
    return p.select(
        *keys, F.coalesce("n_messages", F.lit(0)).alias("n_messages"), *[F.coalesce(F.hll_sketch_estimate(f"sketch_{c}"), F.lit(0)).alias(f"n_distinct_{c}") for c in DISTINCT_COLUMNS],
        "min_latitude", "max_latitude", "min_longitude", "max_longitude",
        average("sum_chars").alias("avg_chars"), average("sum_words").alias("avg_words"))


# -- bounds from file statistics -------------------------------------------------------------------------------

def bounds_from_files(spark: SparkSession, path: str) -> DataFrame:
    """Number of messages and coordinate bounds of a Parquet copy of messages, from the files' footers: no row is read.

    Parquet's reader pushes count, min and max into the footers where asked to; that and the newer reader that can do it are
    switched on in a session of their own, so the caller's settings stay. Files whose writer left the statistics out (a NaN
    among the coordinates) make the query fail; ``bounds`` reads the column instead.
    """
    own = spark.newSession()
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    own.conf.set("spark.sql.sources.useV1SourceList", "")
    return own.read.parquet(path).agg(F.count(F.lit(1)).alias("n_messages"), *bound_columns())
