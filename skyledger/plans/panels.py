"""Dashboard panels over the stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.functions.display import (
    dome_colour,
    dome_text,
    qber_band,
    qber_gauge,
    severity_colour,
)
from skyledger.plans.views import newest, within

# Fixed value: alerts shown in the alert panel.
SHOWN_ALERTS = 10


def series(rows: DataFrame, value: str, start, end, metric: str | None = None) -> DataFrame:
    """A time series of one column: time_sec, value and, if named, metric; oldest first.

    Arrival order closes the sort, so rows of one moment spread over tasks.
    """
    named = [F.lit(metric).alias("metric")] if metric else []
    return (
        within(rows, start, end)
        .orderBy("timestamp", "ord")
        .select(F.col("timestamp").alias("time_sec"), F.col(value).alias("value"), *named)
    )


def temperature_series(environment: DataFrame, start, end) -> DataFrame:
    return series(environment, "temperature", start, end, metric="Temperature")


def wind_series(environment: DataFrame, start, end) -> DataFrame:
    return series(environment, "wind_speed", start, end)


def qber_series(link: DataFrame, start, end) -> DataFrame:
    return series(link, "qber", start, end)


def latest_qber(link: DataFrame) -> DataFrame:
    """The newest error rate, its colour and gauge share. A newest NULL stays NULL."""
    one = newest(link, 1, "timestamp", ["qber"])
    return one.select("qber", qber_band(F.col("qber")).alias("band"), qber_gauge(F.col("qber")).alias("gauge"))


def dome_status(environment: DataFrame) -> DataFrame:
    """The newest dome state with its text and colour."""
    one = newest(environment, 1, "timestamp", ["dome_open"])
    return one.select(
        "dome_open", dome_text(F.col("dome_open")).alias("state"), dome_colour(F.col("dome_open")).alias("colour")
    )


def recent_alerts(alerts: DataFrame) -> DataFrame:
    """The newest alerts with the colour of their severity."""
    shown = newest(alerts, SHOWN_ALERTS, "timestamp", ["timestamp", "severity", "component", "description"])
    return shown.withColumn("colour", severity_colour(F.col("severity")))
