"""Time column expressions. Micros keep every comparison exact."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SECOND = 1_000_000


def micros(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def bucket(us: Column, size_us: int) -> Column:
    """Number of the fixed-length bucket holding ``us`` (exact, also before 1970)."""
    return ((us - F.pmod(us, F.lit(size_us))) / size_us).cast("long")


def whole_seconds(epoch: Column) -> Column:
    """Epoch seconds (fraction dropped) as an instant."""
    return F.timestamp_seconds(epoch.cast("long"))


def seconds_between(later: Column, earlier: Column) -> Column:
    """Whole seconds, truncated towards zero."""
    return F.timestamp_diff("SECOND", earlier, later)


def plus_seconds(ts: Column, seconds: int) -> Column:
    return ts + F.make_dt_interval(secs=F.lit(float(seconds)))


def hour_floor(ts: Column) -> Column:
    return F.date_trunc("hour", ts)


def iso_to_epoch(text: Column) -> Column:
    """ISO text with zone (or Z) to epoch seconds, null when it cannot be read."""
    return F.unix_seconds(text.try_cast("timestamp"))


def next_hour(ts: Column) -> Column:
    """Start of the hour after the one holding ``ts``."""
    return plus_seconds(hour_floor(ts), 3600)
