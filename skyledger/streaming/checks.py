"""Checks of streamed rows against what their table allows: required values and value domains.

Rows come from exports and other producers that no parser has seen. A batch is checked and
written in one pass, good rows and bad ones into folders of their own, with the reasons; the
counts are observed on the way and stored beside them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from skyledger.operators.quality import DOMAINS, outside_domain
from skyledger.schemas import KEYPOOL_TABLES, REQUIRED_COLUMNS
from skyledger.streaming.warehouse import BATCH, Warehouse

ACCEPTED, VIOLATIONS = "accepted", "violations"
COUNTS = "violation_counts"
COUNT_SHAPE = "table_name string, violation string, rows long"
# Columns of the key-pool tables that may not be empty; all of them.
REQUIRED = REQUIRED_COLUMNS | KEYPOOL_TABLES


def violations(table: str, columns: list[str]) -> Column:
    """What is wrong with a row, as `missing:<column>` and `outside:<column>`, in column order."""
    found = [F.when(F.col(c).isNull(), f"missing:{c}") for c in REQUIRED[table]]
    found += [F.when(outside_domain(c), f"outside:{c}") for c in DOMAINS if c in columns]
    return F.filter(F.array(*found), lambda v: v.isNotNull())


def possible(table: str, columns: list[str]) -> list[str]:
    return [f"missing:{c}" for c in REQUIRED[table]] + [f"outside:{c}" for c in DOMAINS if c in columns]


def store_checked(warehouse: Warehouse, rows: DataFrame, table: str, batch_id: int) -> None:
    """Write a batch of rows of a table, the good and the bad apart, and count the violations.

    The counts are observed while the rows are written, so nothing is read for them. They are
    stored last: a batch without counts is one that has failed, and is written again.
    """
    columns, spark = rows.columns, rows.sparkSession
    wrong = possible(table, columns)
    marked = rows.withColumn(VIOLATIONS, violations(table, columns))
    marked = marked.withColumn(ACCEPTED, F.size(VIOLATIONS) == 0)
    seen = Observation()
    told = [F.count_if(F.array_contains(VIOLATIONS, v)).alias(v) for v in wrong]
    observed = marked.observe(seen, F.count(F.lit(1)).alias("rows"), F.count_if(ACCEPTED).alias(ACCEPTED), *told)
    warehouse.write(observed, checked_folder(table), batch_id, ACCEPTED)
    counts = [(table, name, count) for name, count in seen.get.items()]
    warehouse.write(spark.createDataFrame(counts, COUNT_SHAPE).coalesce(1), f"{COUNTS}/{table}", batch_id)


def checked_folder(table: str) -> str:
    return f"checked_{table}"


def _part(warehouse: Warehouse, spark: SparkSession, table: str, accepted: bool) -> DataFrame | None:
    rows = warehouse.read(spark, checked_folder(table))
    return None if rows is None else rows.where(F.col(ACCEPTED) == accepted).drop(ACCEPTED, BATCH)


def accepted_rows(warehouse: Warehouse, spark: SparkSession, table: str) -> DataFrame | None:
    """The rows of a checked table; the folders of bad rows are not listed for reading."""
    rows = _part(warehouse, spark, table, True)
    return None if rows is None else rows.drop(VIOLATIONS)


def quarantined_rows(warehouse: Warehouse, spark: SparkSession, table: str) -> DataFrame | None:
    """The rows a table has refused, with what is wrong with them."""
    return _part(warehouse, spark, table, False)


def violation_counts(warehouse: Warehouse, spark: SparkSession, table: str) -> DataFrame | None:
    """Per violation, and as `rows` and `accepted`, the rows of all batches."""
    rows = warehouse.read(spark, f"{COUNTS}/{table}")
    return None if rows is None else rows.groupBy("table_name", "violation").agg(F.sum("rows").alias("rows"))
