"""Views over the stored tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyledger.functions.display import pool_type_rank
from skyledger.functions.times import in_last_day, in_range, reference_moment
from skyledger.sources.tables import DAY

# Row limits of the latest-N views.
LATEST_READINGS = 100
RECENT_PASSES = 50

# Columns of the views.
LATEST_ENVIRONMENT_COLUMNS = [
    "timestamp", "ogs_id", "dome_open", "temperature", "wind_speed", "humidity",
    "cloud_cover", "precipitation",
]
LATEST_LINK_COLUMNS = [
    "timestamp", "pass_id", "quantum_locked", "tracking_status", "qber",
    "link_power_margin", "received_power",
]
RECENT_PASS_COLUMNS = [
    "pass_id", "satellite_id", "start_time", "end_time", "lock_percentage",
    "keys_distilled", "key_size_bits", "notes",
]
ACTIVE_ALERT_COLUMNS = ["timestamp", "severity", "component", "description", "action_taken"]


def key_creation_summary(key_creations: DataFrame) -> DataFrame:
    """Keys per pool type, site pair and day."""
    return key_creations.groupBy(
        "key_pool_type", "source_site_id", "destination_site_id", F.to_date("timestamp").alias("date")
    ).agg(
        F.count(F.lit(1)).alias("total_keys"),
        F.min("timestamp").alias("first_key"),
        F.max("timestamp").alias("last_key"),
    )


def latency_stats(sync_latency: DataFrame) -> DataFrame:
    """Latency per day; the mean has four decimals."""
    return sync_latency.groupBy(F.to_date("timestamp").alias("date")).agg(
        F.round(F.avg("latency_ms"), 4).alias("avg_latency"),
        F.min("latency_ms").alias("min_latency"),
        F.max("latency_ms").alias("max_latency"),
        F.count(F.lit(1)).alias("measurement_count"),
    )


def daily_key_production(key_creations: DataFrame) -> DataFrame:
    """Keys per day and pool type, newest day first, types in declaration order."""
    return (
        key_creations.groupBy(F.to_date("timestamp").alias("date"), "key_pool_type")
        .agg(
            F.count(F.lit(1)).alias("keys_produced"),
            F.min("sequence_number").alias("first_sequence"),
            F.max("sequence_number").alias("last_sequence"),
        )
        .orderBy(F.desc("date"), pool_type_rank(F.col("key_pool_type")))
    )


def newest(rows: DataFrame, count: int, moment: str, columns: list[str] | list[Column]) -> DataFrame:
    """The newest `count` rows; equal times fall back to arrival, newest first.

    On a table cut by day only the newest days holding `count` rows are read: the day
    counts come from file footers, and the bound prunes day folders before the scan.
    A single `orderBy.limit` keeps `count` rows per task and never sorts the table.
    """
    source = rows
    if DAY in rows.columns and moment == "timestamp":
        source = rows.where(F.col(DAY) >= _first_day_needed(rows, count))
    return source.orderBy(F.desc(moment), F.desc("ord")).limit(count).select(*columns)


def _first_day_needed(rows: DataFrame, count: int) -> Column:
    """The day on which a walk back from the newest has met `count` rows.

    One row per day, so the running total is over a few thousand rows at most.
    """
    per_day = rows.groupBy(DAY).agg(F.count(F.lit(1)).alias("n"))
    running = F.sum("n").over(Window.orderBy(F.desc(DAY)))
    reached = per_day.withColumn("total", running)
    bound = F.coalesce(F.max(F.when(F.col("total") >= count, F.col(DAY))), F.min(DAY))
    return reached.agg(bound).scalar()


def latest_environment(environment: DataFrame) -> DataFrame:
    return newest(environment, LATEST_READINGS, "timestamp", LATEST_ENVIRONMENT_COLUMNS)


def latest_link(link: DataFrame) -> DataFrame:
    return newest(link, LATEST_READINGS, "timestamp", LATEST_LINK_COLUMNS)


def recent_passes(pass_summary: DataFrame) -> DataFrame:
    """The newest passes by start; a pass without start time comes last. The tie-break
    is the order in which passes were first stored."""
    ordered = pass_summary.withColumnRenamed("first_ord", "ord")
    return newest(ordered, RECENT_PASSES, "start_time", RECENT_PASS_COLUMNS)


def active_alerts(alerts: DataFrame, as_of=None) -> DataFrame:
    """Alerts of the last 24 hours before `as_of`, newest first; of a table cut by day the
    days before are not listed."""
    recent = alerts.where(in_last_day(F.col("timestamp"), as_of))
    if DAY in alerts.columns:
        recent = recent.where(F.col(DAY) >= F.date_sub(F.to_date(reference_moment(as_of)), 1))
    return (
        recent
        .orderBy(F.desc("timestamp"), F.desc("ord"))
        .select(*ACTIVE_ALERT_COLUMNS)
    )


def within(rows: DataFrame, start, end, moment: str = "timestamp") -> DataFrame:
    """Rows of a closed time range; on a table cut by day the other days are not listed."""
    chosen = rows.where(in_range(F.col(moment), start, end))
    if DAY in rows.columns and moment == "timestamp":
        chosen = chosen.where(
            F.col(DAY).between(
                F.lit(str(start)).cast("timestamp_ntz").cast("date"),
                F.lit(str(end)).cast("timestamp_ntz").cast("date"),
            )
        )
    return chosen
