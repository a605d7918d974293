"""Event-time helpers.

All window arithmetic is done on epoch microseconds, which is independent of
the session time zone.  Wall-clock ``timestamp_ntz`` inputs are read as UTC.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_UNITS = {
    "us": 1, "microsecond": 1, "microseconds": 1,
    "ms": 1_000, "millisecond": 1_000, "milliseconds": 1_000,
    "s": 1_000_000, "sec": 1_000_000, "second": 1_000_000, "seconds": 1_000_000,
    "min": 60_000_000, "minute": 60_000_000, "minutes": 60_000_000,
    "h": 3_600_000_000, "hour": 3_600_000_000, "hours": 3_600_000_000,
    "d": 86_400_000_000, "day": 86_400_000_000, "days": 86_400_000_000,
}

_EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def duration_us(d) -> int:
    """'15 minutes' / '5 s' / 2_000_000 (already microseconds) -> microseconds."""
    if isinstance(d, int):
        return d
    m = re.fullmatch(r"\s*(\d+)\s*([a-zA-Z]+)\s*", str(d))
    if not m or m.group(2).lower() not in _UNITS:
        raise ValueError(f"unsupported duration: {d!r}")
    return int(m.group(1)) * _UNITS[m.group(2).lower()]


def floor_div(c: Column, d: int) -> Column:
    """Exact floor(c / d) for a bigint column and a positive constant."""
    c = c.cast("long")
    return F.call_function("div", c - F.pmod(c, F.lit(d)), F.lit(d))


def from_epoch_us(c: Column) -> Column:
    return F.timestamp_micros(c)


def ntz_to_instant(c: Column) -> Column:
    """A ``timestamp_ntz`` wall clock read as UTC -> instant."""
    return F.timestamp_micros(F.timestamp_diff("MICROSECOND", F.expr(_EPOCH_NTZ), c))


def event_time(df: DataFrame, name: str, unit: str = "s") -> Column:
    """Column ``name`` of ``df`` as an event-time TimestampType instant.

    bigint inputs are epoch numbers in ``unit`` ('s' or 'ms', as the two
    record families of the reference use); ``timestamp_ntz`` is a UTC wall
    clock; ``timestamp`` passes through.
    """
    dtype = df.schema[name].dataType
    c = F.col(name)
    if isinstance(dtype, T.TimestampNTZType):
        return ntz_to_instant(c)
    if isinstance(dtype, T.TimestampType):
        return c
    if isinstance(dtype, (T.LongType, T.IntegerType)):
        return F.timestamp_millis(c) if unit == "ms" else F.timestamp_seconds(c)
    raise TypeError(f"cannot use {dtype} as event time")


def epoch_ms(c: Column) -> Column:
    return F.unix_millis(c)


def epoch_s(c: Column) -> Column:
    return F.unix_seconds(c)


def _utc_ntz(c: Column) -> Column:
    return F.timestamp_add("MICROSECOND", F.unix_micros(c), F.expr(_EPOCH_NTZ))


def utc_string(c: Column, fmt: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    """Render an instant as a UTC wall-clock string, whatever the session zone."""
    return F.date_format(_utc_ntz(c), fmt)


def java_timestamp_string(c: Column) -> Column:
    """``java.sql.Timestamp.toString`` layout in UTC: seconds, then the
    fraction without trailing zeros but at least one digit ('...:00.0')."""
    frac = F.lpad(F.pmod(F.unix_micros(c), F.lit(1_000_000)).cast("string"), 6, "0")
    frac = F.regexp_replace(frac, "0+$", "")
    frac = F.when(frac == "", F.lit("0")).otherwise(frac)
    return F.concat(utc_string(c, "yyyy-MM-dd HH:mm:ss"), F.lit("."), frac)


def next_utc_midnight(c: Column) -> Column:
    """first instant of the following UTC day."""
    day = duration_us("1 day")
    return F.timestamp_micros((floor_div(F.unix_micros(c), day) + 1) * day)
