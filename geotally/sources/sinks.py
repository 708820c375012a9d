"""Text sinks: tab-separated lines, written by the executors (nothing is collected on the driver).

Large results are written as ordered part files (a global sort gives range-partitioned, sorted parts whose names
follow the order). ``single_file=True`` is for small results only: one task writes one sorted part file. ``write_joined`` makes one
file of any size: ordered parts written by many tasks, joined by the file system.
Default mode ``errorifexists`` refuses to overwrite an existing result directory.

A row is always one line and a field never spills into the next: backslash, tab, line feed, carriage return and NUL
inside a field are written as ``\\\\``, ``\\t``, ``\\n``, ``\\r`` and ``\\0``. ``tsv.parse_lines(..., escaped=True)`` undoes that.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.errors import UnsupportedOperationException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.fmt import escape, py_float
from ..functions.text import FIELD_SEP


def render(df: DataFrame, col: str, null: str = "") -> Column:
    """A field as text: doubles as Python renders them, NULL as ``null``, everything else cast; texts escaped."""
    dtype = df.schema[col].dataType
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        value = py_float(col)
    else:
        value = F.col(col).cast("string")
        value = escape(value) if isinstance(dtype, T.StringType) else value
    return F.coalesce(value, F.lit(null))


def tsv_lines(df: DataFrame, columns: Sequence[str] | None = None, trailing_tab: bool = False,
              null: str = "") -> Column:
    cols = list(columns or df.columns)
    line = F.concat_ws(FIELD_SEP, *[render(df, c, null) for c in cols])
    return F.concat(line, F.lit(FIELD_SEP)) if trailing_tab else line


def write_lines(df: DataFrame, line: Column, path: str, order_by: Sequence[Column | str] = (),
                single_file: bool = False, mode: str = "errorifexists") -> None:
    """Write one text line per row, in ``order_by`` order (ordered part files, or one file if asked).

    ``order_by`` refers to columns of ``df`` (names or sort orders such as ``F.desc("n")``).
    """
    out = df.withColumn("__line", line)
    order = list(order_by)
    if single_file:
        out = out.repartition(1)
        if order:
            out = out.sortWithinPartitions(*order)
    elif order:
        out = out.orderBy(*order)
    out.select(F.col("__line").alias("value")).write.mode(mode).text(path)


def _concat(spark: SparkSession, first: str, others: list[str]) -> bool:
    """Append files to the first by moving their blocks, without reading them; False where the file system can't."""
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(first)
    paths = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Path, len(others))
    for i, other in enumerate(others):
        paths[i] = jvm.org.apache.hadoop.fs.Path(other)
    try:
        target.getFileSystem(spark._jsc.hadoopConfiguration()).concat(target, paths)
    except UnsupportedOperationException:
        return False
    return True


def write_joined(df: DataFrame, line: Column, path: str, order_by: Sequence[Column | str]) -> bool:
    """Write one text line per row, in order, as the one file ``path``/part-00000; refuses an existing ``path``.

    Many tasks write ordered parts beside it, which the file system then joins (``concat``, as HDFS has it: block lists are
    joined, no byte is read). Where it can't (the result is False), one task writes the file, as ``single_file`` does.
    """
    spark = df.sparkSession
    hadoop = spark._jvm.org.apache.hadoop.fs
    base = path.rstrip("/")
    folder, parts = hadoop.Path(base), hadoop.Path(f"{base}.parts-{uuid.uuid4().hex}")
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.exists(folder):
        raise FileExistsError(path)
    write_lines(df, line, parts.toString(), order_by)
    try:
        found = sorted(f.getPath().toString() for f in fs.listStatus(parts) if f.getPath().getName().startswith("part-") and f.getLen())
        if len(found) > 1 and not _concat(spark, found[0], found[1:]):
            write_lines(df, line, base, order_by, single_file=True)
            return False
        fs.mkdirs(folder)
        if found:
            fs.rename(hadoop.Path(found[0]), hadoop.Path(f"{base}/part-00000"))
        return True
    finally:
        fs.delete(parts, True)


def write_tsv(df: DataFrame, path: str, columns: Sequence[str] | None = None,
              order_by: Sequence[Column | str] = (), single_file: bool = False, trailing_tab: bool = False,
              mode: str = "errorifexists") -> None:
    """Write ``df`` as tab-separated lines (no header), optionally ordered."""
    write_lines(df, tsv_lines(df, columns, trailing_tab), path, order_by, single_file, mode)


def prediction_lines(predictions: DataFrame) -> DataFrame:
    """``(input_id, line)``: per input ``place<TAB>prob<TAB>`` for each chosen place (two on a tie, by name), or
    ``<TAB><TAB>`` when nothing matched. Each input holds at most two rows, so the grouping is bounded."""
    cell = F.concat(F.coalesce(escape(F.col("place_name")), F.lit("")), F.lit(FIELD_SEP),
                    F.coalesce(py_float("prob"), F.lit("")), F.lit(FIELD_SEP))
    cells = F.sort_array(F.collect_list(F.struct(F.col("place_name").alias("p"), cell.alias("c"))))
    return predictions.groupBy("input_id").agg(
        F.array_join(F.transform(cells, lambda x: x["c"]), "").alias("line"))


def write_predictions(predictions: DataFrame, path: str, single_file: bool = False,
                      mode: str = "errorifexists", inputs: DataFrame | None = None) -> None:
    """One line per input, in input order (see ``prediction_lines``): range-partitioned, ordered part files, so
    a large batch of inputs is written by many tasks; ``single_file=True`` only for small batches.

    With ``inputs`` every line begins with the (escaped) text of the input that it answers; without, the bare line is
    for a single input."""
    lines = prediction_lines(predictions)
    if inputs is not None:
        lines = lines.join(inputs.select("input_id", F.coalesce(escape(F.col("text")), F.lit("")).alias("__text")), "input_id")
        lines = lines.withColumn("line", F.concat("__text", F.lit(FIELD_SEP), "line"))
    write_lines(lines, F.col("line"), path, order_by=["input_id"], single_file=single_file, mode=mode)
