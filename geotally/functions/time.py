"""Time expressions in exact integer arithmetic, independent of the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MS_PER_SECOND = 1000
SECONDS_PER_HOUR = 3600
SECONDS_PER_DAY = 86400


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _floor_div(x: Column, d: int) -> Column:
    # (x - pmod(x, d)) is an exact multiple of d, so the quotient is an exact integer (|x| < 2^53).
    return ((x - F.pmod(x, F.lit(d))) / F.lit(d)).cast("long")


def epoch_millis(ts_ntz: str | Column) -> Column:
    """Milliseconds since 1970-01-01 of a TIMESTAMP_NTZ value, floored, without any zone conversion."""
    return F.timestamp_diff("MILLISECOND", F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"), _col(ts_ntz))


def local_hour(utc_ms: str | Column, offset_s: str | Column) -> Column:
    """Hour of day (0-23) at ``utc_ms`` (epoch ms, UTC) shifted by ``offset_s`` seconds.

    Seconds are floored (so times before 1970 land in the previous second), the offset is added, and the
    result is taken modulo one day. No session zone enters the computation.
    """
    seconds = _floor_div(_col(utc_ms).cast("long"), MS_PER_SECOND) + _col(offset_s).cast("long")
    second_of_day = F.pmod(seconds, F.lit(SECONDS_PER_DAY))
    return _floor_div(second_of_day, SECONDS_PER_HOUR).cast("int")
