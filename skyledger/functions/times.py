"""Time rules: log times, package times and time-range predicates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A date, a `T`, a clock time and a fraction of one to six digits; year 0 is no year.
LOG_TIME_SHAPE = (
    r"\A(?!0000)\d{4}-\d{1,2}-\d{1,2}T\d{1,2}:\d{1,2}:\d{1,2}\.\d{1,6}\z"
)


def log_time(token: Column) -> Column:
    """Wall-clock time of a log line. What follows `+` is ignored, anything else that
    does not fit the shape gives NULL."""
    wall = F.substring_index(token, "+", 1)
    return F.when(wall.rlike(LOG_TIME_SHAPE), wall.try_cast("timestamp_ntz"))


def package_time_text(text: Column) -> Column:
    """Package time as stored text: no `Z`, no fraction, a blank for `T`."""
    plain = F.substring_index(F.replace(text, F.lit("Z"), F.lit("")), ".", 1)
    return F.when(text != "", F.replace(plain, F.lit("T"), F.lit(" ")))


def package_time(text: Column) -> Column:
    """Package time as a zone-less timestamp, NULL when it is none."""
    return package_time_text(text).try_cast("timestamp_ntz")


def as_moment(value) -> Column:
    """A zone-less timestamp from a literal or a column."""
    column = value if isinstance(value, Column) else F.lit(str(value))
    return column.cast("timestamp_ntz")


def utc_now() -> Column:
    """The current moment on the UTC wall clock."""
    return F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()).cast("timestamp_ntz")


def in_range(moment: Column, start, end) -> Column:
    """Inclusive on both ends, on the raw column so that it reaches the scan."""
    return moment.between(as_moment(start), as_moment(end))


def reference_moment(as_of=None) -> Column:
    """`as_of`, or now."""
    return utc_now() if as_of is None else as_moment(as_of)


def in_last_day(moment: Column, as_of=None) -> Column:
    """Strictly newer than 24 hours before `as_of` (default: now)."""
    return moment > reference_moment(as_of) - F.expr("INTERVAL 24 HOURS")
