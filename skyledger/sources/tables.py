"""Stored tables: Parquet folders, cut by day and sorted by time."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DAY = "event_date"


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def by_day(rows: DataFrame, moment: str = "timestamp") -> DataFrame:
    """Add the day column a table is cut by."""
    return rows.withColumn(DAY, F.to_date(moment))


def write_by_day(rows: DataFrame, path: str, moment: str = "timestamp", mode: str = "append") -> None:
    """Write one folder per day, sorted by time inside each file.

    The rebalance hint lets AQE merge small days into one task and cut a hot day into
    several, so file sizes hold however the days are filled.
    """
    (
        by_day(rows, moment)
        .hint("rebalance", DAY)
        .sortWithinPartitions(DAY, moment)
        .write.mode(mode)
        .partitionBy(DAY)
        .parquet(path)
    )

