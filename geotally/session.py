"""Session helpers: a builder for local runs and lineage cuts into the shared checkpoint folder.

Library functions never create a session; they take DataFrames. The builder here is for tests, the bench and
command-line jobs. On a cluster the caller's session (and its ``spark.checkpoint.dir``) is used as given.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings that matter at scale; all are plain Spark configuration.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Rows are narrow (a few short strings and numbers): 128 MB splits keep tasks short without tiny files.
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[*]", shuffle_partitions: int | None = None, app: str = "geotally",
                  extra: dict[str, str] | None = None) -> SparkSession:
    """A session with ``SCALE_CONF``. Without ``shuffle_partitions`` a local session gets eight and any other the
    cluster's own setting. No checkpoint folder is needed until a table is written there."""
    if shuffle_partitions is None and master.startswith("local"):
        shuffle_partitions = 8
    builder = SparkSession.builder.master(master).appName(app)
    conf = dict(SCALE_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Return the shared checkpoint folder named by the session; set one only when none is configured.

    A cluster names a shared folder in ``spark.checkpoint.dir``; that one always wins. The fallback (a folder
    under ``/tmp``) is used only for a ``local[...]`` master, as in tests: on a cluster a machine-local folder
    would scatter the written tables over the executors' disks, so an unset setting is an error there.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect sessions have no SparkContext: use the configured folder as is.
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if not configured:
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors") from None
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured and not fallback and not sc.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors (e.g. on HDFS or S3)")
    target = configured or fallback or os.path.join("/tmp", "geotally-checkpoints")
    sc.setCheckpointDir(target)
    return sc.getCheckpointDir() or target


def _write_table(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tables/{name}-{uuid.uuid4().hex}"
    df.write.mode("errorifexists").parquet(path)
    # The schema is known: reading with it skips the footer-inference job.
    return spark.read.schema(df.schema).parquet(path), path


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read it back.

    This cuts the lineage: if an executor is lost later, the recomputation starts from the written files, not
    from the raw input. The written table is reusable (column pruning and filter pushdown apply on re-read). It stays
    as long as the folder does, since a lazy result may still read it; ``written_table`` drops its table.
    """
    return _write_table(df, name)[0]


def drop_table(spark: SparkSession, path: str) -> None:
    """Delete a written table through the folder's own file system."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def written_table(df: DataFrame, name: str) -> Iterator[DataFrame]:
    """``materialize`` for the length of a block; the table is dropped at its end."""
    table, path = _write_table(df, name)
    try:
        yield table
    finally:
        drop_table(df.sparkSession, path)
