"""Binding of the message table (and prediction inputs) to the Parquet tables of the test data set.

``documents ⋈ events (doc_id = event_id) ⋈ customer (user_id = c_custkey) ⋈ nation (c_nationkey)`` yields one
message per document with all 13 typed columns. Only the columns a query uses are read (Parquet column pruning
goes through the joins), and filters on derived columns are pushed into the scans where Catalyst can.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema as S
from ..functions.text import char_length, word_count
from ..functions.time import epoch_millis

# Stored types of the columns this binding reads. Declaring them skips schema inference (a job
# per read) and reads only these columns.
TABLE_SCHEMAS = {
    "documents": "doc_id bigint, text string, lang string, source string",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "nation": "n_nationkey int, n_name string",
    "benchmark": "item_id bigint, text string",
}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read
    if name in TABLE_SCHEMAS:
        reader = reader.schema(TABLE_SCHEMAS[name])
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def messages_from_tables(spark: SparkSession, sf_dir: str, top: DataFrame | None = None,
                         measures: bool = False) -> DataFrame:
    """The 13-column message table derived from ``documents``, ``events``, ``customer`` and ``nation``.

    One join order for all sizes: the narrow per-event attributes are joined first and the wide documents last, so
    a text is shuffled once at most. Which joins are broadcasts is left to the planner's sizes and AQE.

    ``measures`` adds ``text_chars`` and ``text_words``, taken where the documents are scanned: an analysis of lengths
    then shuffles two numbers per document instead of its text. ``top`` (at most a few rows: place name and further
    columns, as from ``words.top_groups``) keeps only those places' messages, also before the join, and adds its columns.
    """
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    extra = []
    if measures:
        docs = docs.withColumns({S.TEXT_CHARS: char_length("text"), S.TEXT_WORDS: word_count("text")})
        extra += [S.TEXT_CHARS, S.TEXT_WORDS]
    if top is not None:
        # Bounded by its limit, hence safe to broadcast.
        docs = docs.join(F.broadcast(top.withColumnRenamed(S.PLACE_NAME, "source")), "source")
        extra += [c for c in top.columns if c != S.PLACE_NAME]
    events = read_table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    customer = read_table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    # nation's few keys meet the customers only, never the events or the messages.
    owners = customer.join(nation, customer.c_nationkey == nation.n_nationkey)
    per_event = events.join(owners, events.user_id == owners.c_custkey)
    joined = docs.join(per_event, docs.doc_id == per_event.event_id)
    return joined.select(
        epoch_millis("ts").alias(S.UTC_TIME),
        F.col("n_name").alias(S.COUNTRY_NAME),
        F.upper("lang").alias(S.COUNTRY_CODE),
        F.when(F.col("event_type") == "error", F.lit("admin")).otherwise(F.lit("city")).alias(S.PLACE_TYPE),
        F.col("source").alias(S.PLACE_NAME),
        F.col("lang").alias(S.LANGUAGE),
        F.col("c_mktsegment").alias(S.USER_SCREEN_NAME),
        F.col("c_name").alias(S.USERNAME),
        ((F.col("n_nationkey") - 12) * 3600).cast("int").alias(S.TIMEZONE_OFFSET),
        F.pmod(F.col("doc_id"), F.lit(500)).cast("int").alias(S.NUMBER_OF_FRIENDS),
        F.col("text").alias(S.TEXT),
        (F.col("c_acctbal") / 120).alias(S.LATITUDE),
        F.col("value").alias(S.LONGITUDE),
        *extra,
    )


def inputs_from_benchmark(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prediction inputs ``(input_id, text)``: every ``benchmark`` item, whole text."""
    return read_table(spark, sf_dir, "benchmark").select(
        F.col("item_id").cast("long").alias("input_id"), F.col("text"))
