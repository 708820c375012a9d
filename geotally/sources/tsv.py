"""Tab-separated message files: one message per line, 13 positional fields, no header, no quoting.

Lines are read with ``spark.read.text`` and split on the tab character, so quotes are data and empty fields stay
``''`` (``read.csv`` would eat quotes and turn empty fields into NULL). Extra fields beyond the 13th are ignored.
Rows that are short or carry a non-numeric value in a numeric field are handled by ``on_bad``:

* ``"fail"``: evaluating such a field raises an error (as indexing/casting would); unused fields are never
  evaluated, so a query that does not touch a bad field still runs;
* ``"null"``: such fields become NULL;
* ``"quarantine"``: returns ``(good, bad)``: typed rows with every field valid, and the raw bad lines.

Compressed inputs (``*.gz``) are read as is; gzip is not splittable, so each file becomes one task: convert large
gz inputs to Parquet once (``write_parquet``) and run the analyses on that. Archives that were cut into parts: ``archives``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schema as S
from ..functions.fmt import unescape
from ..functions.text import FIELD_SEP
from ..session import materialize

ON_BAD = ("fail", "null", "quarantine")
# Fixed value: NULL in an escaped line.
NULL_FIELD = "\\N"
SAMPLE_FRACTION = 0.01


def _field(fields: Column, i: int, strict: bool) -> Column:
    n = F.size(fields)
    if strict:
        return F.when(n > F.lit(i), fields.getItem(i)).otherwise(
            F.raise_error(F.concat(F.lit(f"message line has no field {i}: "), F.array_join(fields, FIELD_SEP))))
    return F.when(n > F.lit(i), fields.getItem(i))


def _typed(raw: Column, dtype: T.DataType, name: str, strict: bool, escaped: bool = False) -> Column:
    if isinstance(dtype, T.StringType):
        return F.when(raw != NULL_FIELD, unescape(raw)) if escaped else raw
    value = raw.try_cast(dtype)
    if strict:
        return F.when(raw.isNotNull() & value.isNull(), F.raise_error(
            F.concat(F.lit(f"bad {name} value: "), raw))).otherwise(value)
    return value


def parse_lines(lines: DataFrame, on_bad: str = "fail", value_col: str = "value", escaped: bool = False):
    """Typed message rows from a one-column DataFrame of raw lines (see module doc for ``on_bad``).

    ``escaped`` reads lines of this library's own sinks: their escapes are undone, and ``\\N`` is NULL. Lines of
    other tools hold backslashes as data.
    """
    if on_bad not in ON_BAD:
        raise ValueError(f"on_bad must be one of {ON_BAD}")
    fields = F.split(F.col(value_col), FIELD_SEP, -1)
    strict = on_bad == "fail"
    if on_bad != "quarantine":
        return lines.select(*[
            _typed(_field(fields, i, strict), f.dataType, f.name, strict, escaped).alias(f.name)
            for i, f in enumerate(S.MESSAGE_SCHEMA.fields)])
    checked = lines.select(F.col(value_col).alias("line"), fields.alias("__f"))
    cols = [_typed(_field(F.col("__f"), i, False), f.dataType, f.name, False, escaped).alias(f.name)
            for i, f in enumerate(S.MESSAGE_SCHEMA.fields)]
    numeric = [f.name for f in S.MESSAGE_SCHEMA.fields if not isinstance(f.dataType, T.StringType)]
    typed = checked.select("line", *cols)
    ok = F.lit(True)
    for name in numeric:
        ok = ok & F.col(name).isNotNull()
    ok = ok & F.col(S.TEXT).isNotNull() & F.col(S.LONGITUDE).isNotNull()
    flagged = typed.withColumn("__ok", ok)
    good = flagged.where("__ok").select(*S.MESSAGE_COLUMNS)
    bad = flagged.where(~F.col("__ok")).select("line")
    return good, bad


def read_lines(spark: SparkSession, path: str | list[str], sample: bool | float = False,
               seed: int | None = None) -> DataFrame:
    """Raw lines of one or more text files (``*.gz`` decompressed on read), optionally a Bernoulli sample.

    ``sample=True`` keeps 1 % of the lines (``sample(False, 0.01, seed)``, as the original tool did); a float is
    used as the fraction. The sample is drawn before parsing, so the parse runs on the sample only.
    """
    lines = spark.read.text(path)
    if sample:
        fraction = SAMPLE_FRACTION if sample is True else float(sample)
        lines = lines.sample(False, fraction, seed)
    return lines


def read_messages(spark: SparkSession, path: str | list[str], on_bad: str = "fail", sample: bool | float = False,
                  seed: int | None = None, escaped: bool = False):
    """Typed messages from tab-separated text files. Returns a DataFrame, or ``(good, bad)`` for quarantine."""
    return parse_lines(read_lines(spark, path, sample, seed), on_bad, escaped=escaped)


# Fields that render alike in every engine, and of which the sample's hash is taken.
SAMPLE_FIELDS = (S.UTC_TIME, S.COUNTRY_NAME, S.COUNTRY_CODE, S.PLACE_TYPE, S.PLACE_NAME, S.LANGUAGE, S.USER_SCREEN_NAME,
                 S.USERNAME, S.TIMEZONE_OFFSET, S.NUMBER_OF_FRIENDS, S.TEXT)
HEX_DIGITS = 15


def sample_limit(fraction: float) -> str:
    """The hexadecimal number under which the first digits of a kept row's hash lie."""
    if not 0 < fraction < 1 or fraction * 16**HEX_DIGITS < 1:
        raise ValueError("fraction must be above 0 (and not too small to keep anything) and below 1")
    return f"{int(fraction * 16**HEX_DIGITS):0{HEX_DIGITS}x}"


def stable_sample(m: DataFrame, fraction: float = SAMPLE_FRACTION, seed: int = 5) -> DataFrame:
    """Row-stable sample: a row is kept iff the MD5 of the seed and of its integer and text fields (joined by ``|``, NULLs
    left out) begins below ``fraction``.

    Unlike ``DataFrame.sample`` the kept rows do not depend on partitioning or file splits, so a re-run after an
    executor loss, or on a re-laid-out copy of the data, keeps exactly the same rows.
    """
    h = F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") for c in SAMPLE_FIELDS]))
    return m.where(F.substring(h, 1, HEX_DIGITS) < F.lit(sample_limit(fraction)))


def read_numbered_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``(file, line_no, number, value)``: every line with its place in its file and its place among all files, from 0.

    Files follow each other by name. Numbers are dense and the same for any split size: a line's place is its place in its
    split plus the lines of the splits before it, counted once. Lines are written once as read (so that the places in a split are
    those that were counted, whatever happens to an executor) and never sorted; per split one row is ordered.
    """
    at = F.monotonically_increasing_id()  # increases by one within a split
    lines = materialize(spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("__start"), at.alias("__at"), "value"), "lines")
    splits = lines.groupBy("file", "__start").agg(F.min("__at").alias("__first"), F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("file").orderBy("__start").rowsBetween(Window.unboundedPreceding, -1)
    files = splits.groupBy("file").agg(F.sum("n").alias("n")).select(
        "file", F.coalesce(F.sum("n").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__files"))
    shifts = splits.select("file", "__start", (F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("__first")).alias("__shift")).join(files, "file")
    return lines.join(shifts, ["file", "__start"]).select(
        "file", (F.col("__at") + F.col("__shift")).alias("line_no"), (F.col("__at") + F.col("__shift") + F.col("__files")).alias("number"), "value")


def read_inputs(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Prediction inputs ``(input_id, text)``: one input per line, all lines kept.

    ``input_id`` is the line's number over all files (by name, then by place in the file), from 0: dense, and the same for
    any splits and whenever the result is evaluated.
    """
    return read_numbered_lines(spark, path).select(F.col("number").alias("input_id"), F.col("value").alias("text"))


def write_parquet(m: DataFrame, path: str, mode: str = "errorifexists",
                  partition_by: tuple[str, ...] = ()) -> None:
    """Store typed messages as Parquet: columnar, splittable, with pushdown and pruning for every later job.

    ``partition_by=("country_code",)`` lays the files out by country code: the per-country analyses (word
    counts, city ranking, top words) then read only their partition (PartitionFilters at the scan). Keep the
    partition column low-cardinality; within a partition Spark still splits files by size.
    """
    writer = m.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Messages stored by ``write_parquet``, with the 13 columns in their usual order."""
    return spark.read.parquet(path).select(*S.MESSAGE_COLUMNS)
