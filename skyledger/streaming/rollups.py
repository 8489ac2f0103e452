"""The daily views of the key pool, kept by a pipeline of their own.

It reads the stored log entries as a stream. Of each key a table holds the first and the last
line of every micro-batch, and so the row the upsert leaves; a line that changes that row gives
two changes, the old row with weight -1 and the new one with weight 1. Each micro-batch stores
its changes by day and brings the groups they touch up to date. Only rows of keys the batch
names leave the table of keys, and no day it does not name is read, but for a group that loses
its least or greatest value.

A row is placed by its arrival, not by the order in which this pipeline meets it. So files that
come late or twice, as after a replayed batch, change nothing they should not.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyledger.functions.display import pool_type_rank
from skyledger.operators import keypool
from skyledger.operators.fold import FIRST, FIRST_ORD, LAST, LAST_ORD, fold_result, fold_state
from skyledger.operators.fold import KEY as KEY_COLUMN
from skyledger.operators.rollup import COUNT, GREATEST, LEAST, WEIGHT, Rollup, roll
from skyledger.streaming.warehouse import BATCH, KeyedTable, Warehouse

CHANGES = "key_changes"
GROUP = "group"
SUMMARY = Rollup("daily_key_summary", ("key_pool_type", "source_site_id", "destination_site_id", "date"), "timestamp")
PRODUCTION = Rollup("daily_key_production", ("date", "key_pool_type"), "sequence_number")
ROLLUPS = (SUMMARY, PRODUCTION)
LATENCY = "daily_latency"
LATENCY_COLUMNS = ["date", "measurements", "total_ms", "least_ms", "greatest_ms"]

KEY = "key_identity"
ROW = ["key_pool_type", "source_site_id", "destination_site_id", "moment", "sequence_number"]
ROW_TYPES = "key_pool_type string, source_site_id int, destination_site_id int, moment string, sequence_number int"
KEY_ENDS = KeyedTable("key_ends", KEY, ["sequence_number"], "key_ends")


# ---------------------------------------------------------------- changes of keys


def key_rows(entries: DataFrame) -> DataFrame:
    """Key creations for the table of keys: the key, its row as plain values, and its place in arrival
    order as text that sorts alike."""
    fields = entries.schema["ord"].dataType.fields
    end = F.lit("\u0001")
    parts = []
    for f in fields:
        value = F.col(f"ord.{f.name}").cast("string")
        parts += [value if isinstance(f.dataType, T.StringType) else F.lpad(value, 19, "0"), end]
    rows = keypool.stored_rows(entries, "key_creations").withColumn("moment", F.col("timestamp").cast("string"))
    return rows.select(KEY, F.concat(*parts).alias("place"), *ROW)


def _state_functions() -> tuple[Callable, str]:
    """What runs in the tasks, and the shape of what it gives. The function is made here, so that
    it travels by value and executors need not have this package."""

    def ends(batches):
        """Of each key in a batch of rows the first and the last: no key is most of a shuffle."""
        for rows in batches:
            ordered = rows.sort_values("place")
            both = pd.concat([ordered.drop_duplicates(KEY), ordered.drop_duplicates(KEY, keep="last")])
            yield both.drop_duplicates([KEY, "place"])

    return ends, f"{KEY} string, place string, {ROW_TYPES}"


def key_ends(rows: DataFrame) -> DataFrame:
    """Of each key the rows of `key_rows` that a fold of them may take, as they are stored: no
    shuffle, and of a key two rows at most per batch of rows."""
    ends, shape = _state_functions()
    return rows.mapInPandas(ends, shape).withColumnRenamed("place", "ord")


def _by_bytes(warehouse: Warehouse) -> Warehouse:
    """The daily views tell keys apart byte by byte, whatever the collation of the tables."""
    return replace(warehouse, collation=None)


def key_changes(now: DataFrame, before: DataFrame | None) -> DataFrame:
    """The changes that a micro-batch makes to the table of keys: a key keeps all of its first
    row, but the number of its last. Both are fold states, None without earlier batches."""
    if before is None:
        return now.select(*_row_after(F.col(FIRST), F.col(LAST)), F.lit(1).alias(WEIGHT))
    touched = before.join(now.select(KEY_COLUMN), KEY_COLUMN, "left_semi")
    both = now.alias("n").join(touched.alias("b"), KEY_COLUMN, "left")
    old, new = {}, {}
    for name in (FIRST, LAST):
        old[name], new[name] = F.col(f"b.{name}"), F.col(f"n.{name}")
    known = F.col(f"b.{FIRST_ORD}").isNotNull()
    first = F.when(known & (F.col(f"b.{FIRST_ORD}") <= F.col(f"n.{FIRST_ORD}")), old[FIRST]).otherwise(new[FIRST])
    last = F.when(known & (F.col(f"b.{LAST_ORD}") > F.col(f"n.{LAST_ORD}")), old[LAST]).otherwise(new[LAST])
    rows = both.select(
        F.when(known, F.struct(*_row_after(old[FIRST], old[LAST]))).alias("old"),
        F.struct(*_row_after(first, last)).alias("new"),
    )
    gone = F.struct("old.*", F.lit(-1).alias(WEIGHT))
    come = F.struct("new.*", F.lit(1).alias(WEIGHT))
    told = F.when(F.col("old").isNull(), F.array(come)).otherwise(F.array(gone, come))
    return rows.where(~F.col("old").eqNullSafe(F.col("new"))).select(F.inline(told))


def _row_after(first: Column, last: Column) -> list[Column]:
    return [(last if name in KEY_ENDS.replaces else first)[name].alias(name) for name in ROW]


def stream_key_rows(spark: SparkSession, warehouse: Warehouse, schema: T.StructType, max_files: int) -> DataFrame:
    """Key creations as the key-pool pipeline stores them."""
    entries = (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", max_files)
        .option("ignoreMissingFiles", True)  # of a batch that was replayed
        .parquet(warehouse.folder("log_entries"))
    )
    return key_rows(entries)


# ---------------------------------------------------------------- daily tables


def rolled_table(name: str, columns: list[str]) -> KeyedTable:
    """A daily table folds to the newest row of each group, so it can be compacted."""
    return KeyedTable(name, GROUP, columns, name)


def _write(warehouse: Warehouse, rows: DataFrame, name: str, group: list[str], batch_id: int) -> None:
    key = F.to_json(F.struct(*group), {"ignoreNullFields": "false"})
    order = F.struct(F.lit(batch_id).cast("long").alias("arrival"))
    warehouse.write(rows.select(key.alias(GROUP), order.alias("ord"), *rows.columns), name, batch_id)


def _before(warehouse: Warehouse, spark: SparkSession, name: str, columns: list[str], batch_id: int) -> DataFrame | None:
    state = warehouse.state(spark, rolled_table(name, columns), upto=batch_id - 1)
    return None if state is None else fold_result(state).select(*columns)


def store_key_changes(warehouse: Warehouse, rows: DataFrame, batch_id: int) -> None:
    """Store the keys of a micro-batch, the changes they make, then the daily groups these touch."""
    spark = rows.sparkSession
    stored = warehouse.write(key_ends(rows), KEY_ENDS.source, batch_id)
    before = _by_bytes(warehouse).state(spark, KEY_ENDS, upto=batch_id - 1)
    changes = key_changes(fold_state(stored, KEY_ENDS.key, replaces=KEY_ENDS.replaces), before)
    timed = changes.withColumn("timestamp", F.col("moment").cast("timestamp_ntz")).drop("moment")
    dated = timed.withColumn("date", F.to_date("timestamp"))
    stored = warehouse.write(dated, CHANGES, batch_id, "date")
    history = warehouse.read(spark, CHANGES)
    history = stored if history is None else history.where(F.col(BATCH) <= batch_id)
    for rollup in ROLLUPS:
        before = _before(warehouse, spark, rollup.name, rollup.columns, batch_id)
        _write(warehouse, roll(stored, before, history, rollup), rollup.name, list(rollup.group), batch_id)


def store_latency(warehouse: Warehouse, latencies: DataFrame, batch_id: int) -> None:
    """Merge the latencies of a batch into their days; nothing takes a measurement back."""
    days = latencies.groupBy(F.to_date("timestamp").alias("date")).agg(
        F.count(F.lit(1)).alias("measurements"),
        F.sum("latency_ms").alias("total_ms"),
        F.min("latency_ms").alias("least_ms"),
        F.max("latency_ms").alias("greatest_ms"),
    )
    before = _before(warehouse, latencies.sparkSession, LATENCY, LATENCY_COLUMNS, batch_id)
    if before is not None:
        touched = before.join(days.select("date"), "date", "left_semi")
        days = touched.unionByName(days).groupBy("date").agg(
            F.sum("measurements").alias("measurements"),
            F.sum("total_ms").alias("total_ms"),
            F.min("least_ms").alias("least_ms"),
            F.max("greatest_ms").alias("greatest_ms"),
        )
    _write(warehouse, days, LATENCY, ["date"], batch_id)


DAILY_TABLES = {r.name: r.columns for r in ROLLUPS} | {LATENCY: LATENCY_COLUMNS}


def daily_table(warehouse: Warehouse, spark: SparkSession, name: str) -> DataFrame | None:
    """One of the daily tables, one row per group."""
    table = warehouse.folded(spark, rolled_table(name, DAILY_TABLES[name]))
    return None if table is None else table.drop(GROUP)


def compact_daily(warehouse: Warehouse, spark: SparkSession) -> dict[str, int | None]:
    """Snapshot the daily tables and the keys they follow; gives the newest batch each covers."""
    covered = {name: warehouse.compact(spark, rolled_table(name, columns)) for name, columns in DAILY_TABLES.items()}
    return covered | {KEY_ENDS.name: _by_bytes(warehouse).compact(spark, KEY_ENDS)}


# ---------------------------------------------------------------- views


def key_creation_summary(summary: DataFrame) -> DataFrame:
    """Keys per pool type, site pair and day, from the daily table."""
    return summary.where(F.col(COUNT) > 0).select(
        "key_pool_type",
        "source_site_id",
        "destination_site_id",
        "date",
        F.col(COUNT).alias("total_keys"),
        F.col(LEAST).alias("first_key"),
        F.col(GREATEST).alias("last_key"),
    )


def daily_key_production(production: DataFrame) -> DataFrame:
    """Keys per day and pool type, newest day first, from the daily table."""
    return (
        production.where(F.col(COUNT) > 0)
        .orderBy(F.desc("date"), pool_type_rank(F.col("key_pool_type")))
        .select(
            "date",
            "key_pool_type",
            F.col(COUNT).alias("keys_produced"),
            F.col(LEAST).alias("first_sequence"),
            F.col(GREATEST).alias("last_sequence"),
        )
    )


def latency_stats(latency: DataFrame) -> DataFrame:
    """Latency per day; the mean has four decimals."""
    return latency.select(
        "date",
        F.round(F.col("total_ms") / F.col("measurements"), 4).alias("avg_latency"),
        F.col("least_ms").alias("min_latency"),
        F.col("greatest_ms").alias("max_latency"),
        F.col("measurements").alias("measurement_count"),
    )
