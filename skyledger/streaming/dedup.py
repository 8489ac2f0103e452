"""Repeated deliveries dropped as they arrive, with state that expires.

A package that is delivered again soon is met in Spark's state store, which forgets it when the
watermark has passed it. What comes later still, older than the watermark, is dropped as late.
So the state holds the packages of one delay, not all there ever were; the package ledger goes
on to decide about the rest.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.functions.times import package_time
from skyledger.operators.station import CHECKED_SECTIONS, section_ok

MOMENT = "package_moment"


def complete_deliveries(packages: DataFrame) -> DataFrame:
    """Deliveries all of whose sections can be stored: only such a one settles its package, so
    only repeats of such a one are idle."""
    every = F.col("package_timestamp").isNotNull()
    for section in CHECKED_SECTIONS:
        every = every & F.coalesce(section_ok(section), F.lit(False))
    return packages.where(every)


def first_within(packages: DataFrame, delay: str, columns: tuple[str, ...] = ("package_timestamp",)) -> DataFrame:
    """Streamed packages without repeats that come within `delay` of the first, by event time.

    Of repeats in one micro-batch any may stay, so `columns` should say all that is read later,
    or repeats should be alike. A package older than the watermark is dropped, and so is one
    whose time cannot be read: it has no place in event time.
    """
    # A watermark wants a zoned timestamp; package times are UTC.
    moment = F.to_utc_timestamp(package_time(F.col("package_timestamp")).cast("timestamp"), F.current_timezone())
    timed = packages.withColumn(MOMENT, moment).where(F.col(MOMENT).isNotNull())
    return timed.withWatermark(MOMENT, delay).dropDuplicatesWithinWatermark(list(columns))
