"""Epoch-millisecond conversion and time-dimension parts.

All arithmetic is done on ``timestamp_ntz`` anchored at the UTC epoch, so the parts are UTC
parts whatever the session time zone is (the source data are UTC epoch milliseconds).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

def _epoch() -> Column:
    return F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'")

# The three weekday conventions found in the pipelines.
#   mon0: Monday = 0 ... Sunday = 6
#   sun0: Sunday = 0 ... Saturday = 6
#   sun1: Sunday = 1 ... Saturday = 7
WEEKDAY_BASES = ("mon0", "sun0", "sun1")


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def epoch_ms_to_ntz(ms) -> Column:
    """Epoch milliseconds (long) -> UTC wall-clock ``timestamp_ntz`` with millisecond precision."""
    return F.timestamp_add("MILLISECOND", _c(ms), _epoch())


def epoch_ms_to_timestamp(ms) -> Column:
    """Epoch milliseconds -> ``timestamp`` (an instant; displayed in the session zone)."""
    return F.timestamp_millis(_c(ms))


def epoch_ms_whole_seconds(ms) -> Column:
    """Epoch milliseconds -> UTC ``timestamp_ntz`` cut to whole seconds (integer division)."""
    ms = _c(ms).cast("long")
    return F.timestamp_add("MILLISECOND", ms - F.pmod(ms, F.lit(1000)), _epoch())


def epoch_ms_to_text(ms) -> Column:
    """Epoch milliseconds -> 'yyyy-MM-dd HH:mm:ss' text in UTC, whole seconds."""
    return F.date_format(epoch_ms_whole_seconds(ms), "yyyy-MM-dd HH:mm:ss")


def ntz_to_epoch_ms(ts) -> Column:
    """UTC wall-clock ``timestamp_ntz`` -> epoch milliseconds (sub-millisecond part dropped).

    Built from the wall-clock parts (days since the epoch, hour, minute, fractional second),
    which involve no time zone. ``timestamp_diff`` would cast through the session zone and be
    an hour off for wall-clock times inside a daylight-saving gap of that zone.
    """
    ts = _c(ts)
    days = F.datediff(F.to_date(ts), F.lit("1970-01-01").cast("date")).cast("long")
    clock = (F.hour(ts).cast("long") * F.lit(3_600_000) + F.minute(ts).cast("long") * F.lit(60_000)
             + F.floor(F.date_part(F.lit("SECOND"), ts) * F.lit(1000)).cast("long"))
    return days * F.lit(86_400_000) + clock


def weekday(ts, base: str = "mon0") -> Column:
    """Day of week under one of the three conventions in ``WEEKDAY_BASES``."""
    ts = _c(ts)
    if base == "mon0":
        return F.weekday(ts)
    if base == "sun0":
        return F.dayofweek(ts) - F.lit(1)
    if base == "sun1":
        return F.dayofweek(ts)
    raise ValueError(f"weekday base must be one of {WEEKDAY_BASES}, got {base!r}")


def time_parts(ts, base: str = "mon0", prefix: str = "") -> list[Column]:
    """hour, day, week (ISO), month, year, weekday of a timestamp column, as ``int`` columns."""
    ts = _c(ts)
    return [
        F.hour(ts).alias(f"{prefix}hour"),
        F.dayofmonth(ts).alias(f"{prefix}day"),
        F.weekofyear(ts).alias(f"{prefix}week"),
        F.month(ts).alias(f"{prefix}month"),
        F.year(ts).alias(f"{prefix}year"),
        weekday(ts, base).cast("int").alias(f"{prefix}weekday"),
    ]
