"""Keeping the counts current while new message files arrive (Structured Streaming).

The analyses are aggregations of counts, so a stream of new files is handled as *partial counts per
micro-batch*: each batch is aggregated with the batch operators and appended under ``<dir>/batch_id=<n>``;
readers sum the partials. No state store grows with the key space, and the sink is exactly-once: the stream's
progress is kept beside its output (``<dir>/_checkpoint``), so a restart in any session goes on where it stopped, and a
replayed batch overwrites its own ``batch_id`` directory (dynamic partition overwrite). One folder belongs to one
stream; a checkpoint folder of one's own must stay with the output folder for as long as that is used.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .. import schema as S
from ..operators import bayes, stats
from ..sources.tsv import parse_lines


def read_message_stream(spark: SparkSession, path: str, on_bad: str = "null",
                        max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming DataFrame of typed messages from tab-separated files appearing under ``path``."""
    if on_bad == "quarantine":
        raise ValueError("quarantine is a batch policy; use 'null' and filter, or 'fail'")
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return parse_lines(reader.load(path), on_bad)


def _write_partial(df: DataFrame, batch_id: int, path: str) -> None:
    (df.withColumn("batch_id", F.lit(batch_id))
       .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy("batch_id").parquet(path))


def start_running_counts(stream: DataFrame, keys: Sequence[str], out_dir: str, checkpoint: str | None = None,
                         available_now: bool = False, processing_time: str | None = None) -> StreamingQuery:
    """Per micro-batch message counts per ``keys`` appended as partial counts under ``out_dir``."""
    keys = list(keys)

    def batch(df: DataFrame, batch_id: int) -> None:
        _write_partial(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")), batch_id, out_dir)

    writer = stream.writeStream.foreachBatch(batch).option(
        "checkpointLocation", checkpoint or f"{out_dir.rstrip('/')}/_checkpoint")
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()


def read_running_counts(spark: SparkSession, out_dir: str, keys: Sequence[str]) -> DataFrame:
    """Current totals: the partial counts of all batches summed per key."""
    return spark.read.parquet(out_dir).groupBy(*keys).agg(F.sum("n").cast("long").alias("n"))


def start_model_updates(stream: DataFrame, model_dir: str, checkpoint: str | None = None,
                        available_now: bool = False, processing_time: str | None = None) -> StreamingQuery:
    """Per micro-batch place-model counts (``Tc`` and ``Tc,w`` in one single-pass aggregate) appended as
    partials under ``model_dir``."""
    base = model_dir.rstrip("/")

    def batch(df: DataFrame, batch_id: int) -> None:
        _write_partial(bayes.place_counts(df.select(S.PLACE_NAME, S.TEXT)), batch_id, f"{base}/counts")

    writer = stream.writeStream.foreachBatch(batch).option(
        "checkpointLocation", checkpoint or f"{base}/_checkpoint")
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()


def read_running_model(spark: SparkSession, model_dir: str) -> bayes.PlaceModel:
    """The place model over everything streamed so far (partials summed per place and per (place, word))."""
    counts = spark.read.parquet(f"{model_dir.rstrip('/')}/counts").groupBy(S.PLACE_NAME, "word").agg(
        F.sum("n").cast("long").alias("n"))
    return bayes.model_from_counts(counts)


def start_profile_updates(stream: DataFrame, profile_dir: str, checkpoint: str | None = None,
                          available_now: bool = False, processing_time: str | None = None) -> StreamingQuery:
    """Per micro-batch one row of mergeable profile parts (counts, bounds, distinct-count sketches) under ``profile_dir``."""
    def batch(df: DataFrame, batch_id: int) -> None:
        _write_partial(stats.profile_parts(df), batch_id, f"{profile_dir.rstrip('/')}/parts")

    writer = stream.writeStream.foreachBatch(batch).option(
        "checkpointLocation", checkpoint or f"{profile_dir.rstrip('/')}/_checkpoint")
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()


def read_running_profile(spark: SparkSession, profile_dir: str) -> DataFrame:
    """The profile of everything streamed so far, from the stored parts alone."""
    return stats.profile_from_parts(spark.read.parquet(f"{profile_dir.rstrip('/')}/parts"))
