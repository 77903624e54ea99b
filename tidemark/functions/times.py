"""Event-time arithmetic in microseconds since the epoch.

All durations are ``datetime.timedelta``.  Columns may be ``timestamp`` or
``timestamp_ntz``; the session time zone is UTC, so both name the same instant.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, TimestampType

DAY = timedelta(days=1)
MICROSECOND = timedelta(microseconds=1)


def to_us(duration: timedelta) -> int:
    return duration // MICROSECOND


def as_duration(duration: timedelta) -> str:
    """The text form ``window`` and ``withWatermark`` take."""
    return f"{to_us(duration)} microseconds"


def epoch_us(ts: Column) -> Column:
    return F.unix_micros(ts.cast(TimestampType()))


def from_epoch_us(us: Column, kind: DataType = TimestampType()) -> Column:
    return F.timestamp_micros(us).cast(kind)


def floor_us(us: Column, step: timedelta) -> Column:
    """Largest multiple of ``step`` that is not after ``us`` (also before 1970)."""
    return us - F.pmod(us, F.lit(to_us(step)))


def day_start(ts: Column) -> Column:
    return from_epoch_us(floor_us(epoch_us(ts), DAY))


def next_midnight(ts: Column) -> Column:
    """Start of the following UTC day: when a daily counter is reset."""
    return day_start(ts) + F.lit(DAY)
