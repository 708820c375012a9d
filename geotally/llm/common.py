"""Shared helpers: table access, written intermediate tables, per-worker caches."""

from __future__ import annotations

import gc
import re
import sys
import time
import types
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FALLBACK_DIR = "/tmp/geotally-llm"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that the cluster names in ``spark.checkpoint.dir``; a local one only for a ``local`` master."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return FALLBACK_DIR


def written(df: DataFrame, what: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: lineage ends there, and a lost executor costs nothing."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/llm-{what}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(table_: DataFrame) -> None:
    """Delete the files of a table from ``written`` that nothing will read again."""
    spark = table_.sparkSession
    for folder in {f.rsplit("/", 1)[0] for f in table_.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def release(spark: SparkSession) -> None:
    """Let Spark drop the shuffle files of jobs whose results have been written: it does so when the driver's garbage
    collector finds them unused, which a small driver heap may not need to for hours. Results don't depend on it."""
    for _ in range(2):
        # The first collection only frees what holds them; their files were all there after one, and gone after two.
        gc.collect()
        time.sleep(0.5)
        spark.sparkContext._jvm.System.gc()


def lowest_hashes(df: DataFrame, by: list[str], rows: int, known: int) -> DataFrame:
    """The ``rows`` rows of the lowest hash of the columns ``by``, of about ``known`` rows in all.

    Rows beyond the share that is sure to suffice leave before the sort, so that the task which takes the lowest ones
    gets little more than ``rows`` rows, however many partitions there are."""
    mark = F.xxhash64(*by)
    if known > 2 * rows:
        df = df.where(F.shiftrightunsigned(mark, 1) < int(2**63 * 2 * rows / known))
    return df.orderBy(mark, *by).limit(rows)


def worker_cache(name: str) -> dict:
    """A dictionary that later tasks of the same Python worker find again. A worker keeps one name's at a time, so that
    operators that follow each other in a worker don't add up their memories."""
    holder = sys.modules.setdefault("_geotally_worker_cache", types.ModuleType("_geotally_worker_cache")).__dict__
    if holder.get("name") != name:
        holder.update(name=name, cache={})
    return holder["cache"]


def slices(batch: pa.RecordBatch, size: int, column: int = 1) -> Iterator[pa.RecordBatch]:
    """The batch in parts of at most ``size`` bytes of the texts in a column (one text at least)."""
    ends = np.cumsum(pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False))
    start = 0
    while start < batch.num_rows:
        done = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, done + size, "right")))
        yield batch.slice(start, stop - start)
        start = stop


#: Words of the corpus operators are runs of anything but these six ASCII blanks (a Java and Python pattern).
BLANKS = " \t\n\x0b\x0c\r"
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
WORD_BYTES = re.compile(rb"[^\x20\x09-\x0D]+")
