"""Gzip archives that were cut into parts by bytes (``split``): lines in order, without joining the parts first.

A cut may fall anywhere, also inside a gzip member or a line, so a part can't be read by itself. Parts are read as bytes
by all executors, go to one task per archive in slices, in order, and are unpacked there as one stream. Only a slice and the
unfinished line are held at a time.

Cost: inflating is sequential, so one archive is one task (about 100 MB of text a second), however many parts it has; several
archives run side by side. Convert once (``python -m geotally convert --gz-parts``); everything later reads splittable Parquet. A
part is read whole by the task that slices it: parts must be below 2 GB and fit an executor, as those made for uploading do.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tsv import parse_lines

#: Bytes of a slice as shuffled, of what is inflated at a time, and of the lines sent on at a time.
SLICE, INFLATED, SENT = 16 << 10, 1 << 20, 4 << 20
#: A gzip header and trailer are expected around the data.
GZIP = 31


class _Archive:
    """One archive's stream: compressed slices in, numbered lines out."""

    def __init__(self, name: str):
        self.name, self.member, self.fed = name, None, False
        self.rest: list[bytes] = []
        self.lines: list[bytes] = []
        self.size, self.first = 0, 0

    def feed(self, data: bytes) -> None:
        while data:
            if self.member is None:
                data = data.lstrip(b"\0") if self.fed else data  # padding between members
                if not data:
                    return
                self.member, self.fed = zlib.decompressobj(GZIP), True
            out = self.member.decompress(data, INFLATED)
            self.text(out)
            while len(out) == INFLATED and not self.member.eof:
                out = self.member.decompress(self.member.unconsumed_tail, INFLATED)
                self.text(out)
            data = self.member.unconsumed_tail
            if self.member.eof:
                data, self.member = self.member.unused_data, None

    def text(self, out: bytes) -> None:
        # A carriage return at the end may be half of a line's end.
        end = max(out.rfind(b"\n"), out.rfind(b"\r", 0, max(len(out) - 1, 0)))
        if end < 0 and not (self.rest and self.rest[-1].endswith(b"\r")):
            self.rest += [out] if out else []
            return
        whole = b"".join([*self.rest, out])
        end = max(whole.rfind(b"\n"), whole.rfind(b"\r", 0, len(whole) - 1))
        if end < 0:
            self.rest = [whole]
            return
        found = whole[: end + 1].splitlines()
        self.rest = [whole[end + 1 :]] if end + 1 < len(whole) else []
        self.lines += found
        self.size += end + 1

    def close(self) -> None:
        if self.member is not None:
            raise EOFError(f"archive {self.name!r} ends inside a gzip member: a part is missing")
        self.lines += b"".join(self.rest).splitlines()
        self.rest = []

    def take(self) -> pa.RecordBatch:
        n, lines = len(self.lines), self.lines
        numbers = pa.array(range(self.first, self.first + n), pa.int64())
        self.first, self.lines, self.size = self.first + n, [], 0
        return pa.RecordBatch.from_arrays([pa.array([self.name] * n, pa.string()), numbers, pa.array(lines, pa.binary())], names=["archive", "line_no", "line"])


def _unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Slices, sorted by archive, part and place, to lines."""
    now: _Archive | None = None
    for batch in batches:
        for name, data in zip(batch.column(0), batch.column(1), strict=True):
            name = name.as_py()
            if now is None or name != now.name:
                if now is not None:
                    now.close()
                    yield now.take()
                now = _Archive(name)
            now.feed(data.as_py())
            if now.size > SENT:
                yield now.take()
    if now is not None:
        now.close()
        yield now.take()


def read_archive_lines(spark: SparkSession, path: str | list[str], archive_pattern: str | None = None) -> DataFrame:
    """``(archive, line_no, value)``: the lines of the archives whose parts are at ``path``, numbered from 0 in each.

    Parts follow each other by file name, as a shell's ``cat part*`` takes them. Without ``archive_pattern`` all files are
    parts of one archive; with it, the first group that it finds in a file's name tells to which archive the part belongs.
    Lines end as in ``spark.read.text``. A missing last part is an error, and so is a missing one in between.
    """
    parts = spark.read.format("binaryFile").load(path)
    name = F.element_at(F.split("path", "/"), -1)
    archive = F.regexp_extract(name, archive_pattern, 1) if archive_pattern else F.lit("")
    cut = F.expr(f"transform(sequence(0L, (length(content) - 1) div {SLICE}), i -> struct(i AS no, substring(content, cast(i * {SLICE} + 1 AS int), {SLICE}) AS data))")
    slices = parts.where(F.length("content") > 0).select(archive.alias("archive"), name.alias("part"), F.explode(cut).alias("s")).select("archive", "part", "s.no", "s.data")
    ordered = slices.repartition("archive").sortWithinPartitions("archive", "part", "no").select("archive", "data")
    lines = ordered.mapInArrow(_unpack, "archive string, line_no long, line binary")
    return lines.select("archive", "line_no", F.col("line").cast("string").alias("value"))


def read_archive_messages(spark: SparkSession, path: str | list[str], on_bad: str = "fail", archive_pattern: str | None = None, escaped: bool = False):
    """Typed messages from the parts of gzip archives (see ``tsv.parse_lines`` for the rest)."""
    return parse_lines(read_archive_lines(spark, path, archive_pattern).select("value"), on_bad, escaped=escaped)
