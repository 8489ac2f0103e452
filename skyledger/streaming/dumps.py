"""Dumps of all tables as of one moment, taken while the pipelines run.

A pipeline writes one table last in each batch. The newest batch of that table is whole in all
the others, and nothing later is whole for certain. A dump fixes that batch per pipeline, in a
manifest, and then takes of every table the batches up to it; what is written meanwhile, or was
left by a failed run, is not in it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.operators import keypool
from skyledger.operators.fold import fold_result
from skyledger.plans import export
from skyledger.schemas import FILE_LEDGER_COLUMNS, KEYPOOL_TABLES, STATION_TABLES, UPSERT_KEYS
from skyledger.streaming.ingest import ENTRIES, NO_ENTRY, keyed_table, ledger_of
from skyledger.streaming.warehouse import BATCH, Warehouse

# The table each pipeline writes last.
LAST_WRITTEN = {"keypool": "processed_files", "station": "ogs_processed_packages"}
KEYPOOL_NAMES = [*KEYPOOL_TABLES, "processed_files"]
STATION_NAMES = list(STATION_TABLES)
SHAPE = "pipeline string, batch long"


def whole_batches(warehouse: Warehouse, spark: SparkSession) -> dict[str, int]:
    """The newest whole batch of each pipeline that has one."""
    found = {}
    for pipeline, table in LAST_WRITTEN.items():
        rows = warehouse.read(spark, table)
        newest = rows.agg(F.max(BATCH)).first()[0] if rows is not None else None
        if newest is not None:
            found[pipeline] = newest
    return found


def table_at(warehouse: Warehouse, spark: SparkSession, name: str, batch: int) -> DataFrame | None:
    """One table as it was when a batch of its pipeline was whole."""
    if name in UPSERT_KEYS:
        state = warehouse.state(spark, keyed_table(warehouse, spark, name), upto=batch)
        columns = KEYPOOL_TABLES.get(name) or STATION_TABLES.get(name) or FILE_LEDGER_COLUMNS
        return None if state is None else fold_result(state).select(*columns)
    rows = warehouse.read(spark, ENTRIES if name in KEYPOOL_TABLES else name)
    if rows is None:
        return None
    rows = rows.where(F.col(BATCH) <= batch)
    if name in KEYPOOL_TABLES:
        entries = rows.withColumn("log_type", F.nullif("log_type", F.lit(NO_ENTRY)))
        return keypool.stored_rows(entries, name).select(*KEYPOOL_TABLES[name])
    if name == LAST_WRITTEN["station"]:
        return ledger_of(rows)
    return rows.select(*STATION_TABLES[name])


def dump_all(warehouse: Warehouse, spark: SparkSession, path: str) -> dict[str, int]:
    """Dump every table below `path`, all as of the whole batches of its manifest; gives those."""
    batches = whole_batches(warehouse, spark)
    spark.createDataFrame(list(batches.items()), SHAPE).coalesce(1).write.mode("errorifexists").json(f"{path}/manifest")
    for pipeline, names in (("keypool", KEYPOOL_NAMES), ("station", [*STATION_NAMES, LAST_WRITTEN["station"]])):
        if pipeline in batches:
            tables = {n: table_at(warehouse, spark, n, batches[pipeline]) for n in dict.fromkeys(names)}
            export.dump({n: rows for n, rows in tables.items() if rows is not None}, path)
    return batches


def dumped_batches(spark: SparkSession, path: str) -> dict[str, int]:
    """The batches a dump holds."""
    return {r["pipeline"]: r["batch"] for r in spark.read.schema(SHAPE).json(f"{path}/manifest").collect()}
