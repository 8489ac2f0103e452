"""Micro-batch functions of the two pipelines, built on the batch operators."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyledger.functions.rows import collated, spread_key
from skyledger.functions.times import package_time
from skyledger.operators import keypool, station
from skyledger.operators.fold import FIRST_ORD, KEY, LAST_ORD, fold
from skyledger.schemas import FILE_LEDGER_COLUMNS, SECTIONS, UPSERT_KEYS, UPSERT_REPLACES
from skyledger.sources.logs import with_arrival_order
from skyledger.sources.tables import DAY, by_day
from skyledger.streaming import rollups
from skyledger.streaming.newest import merge_newest
from skyledger.streaming.progress import COUNTERS, batch_counters
from skyledger.streaming.rollups import store_latency, stream_key_rows
from skyledger.streaming.warehouse import BATCH, KeyedTable, Warehouse, without_batch

NO_ENTRY = "NO_ENTRY"
ENTRIES = "log_entries"
PACKAGE_DAY = "package_date"
ENTERED_ALERTS = "entered_alerts"
ENTRY_FOLDERS = ("log_type", DAY)

# How stored deliveries are cut, so that what a task reads of them fits into its memory.
DELIVERIES_PER_FILE = 50_000
SETTLED_SPLIT = "16m"


# ---------------------------------------------------------------- key pool


def store_log_batch(warehouse: Warehouse, lines: DataFrame, batch_id: int) -> None:
    """Parse a batch of lines once and store it by event kind and day.

    No shuffle: each task writes what it has read. The four fact tables, the quarantine
    and the statistics are all read from this one table, each from its own folders. Files
    that hold no line that counts are in the ledger too, with zeros; Spark hands a file of
    no bytes to no batch, so those come with `mark_empty_files`.
    """
    ordered = with_arrival_order(lines)
    arrived = ordered.withColumn("ord", arrival(batch_id, "ord.*"))
    stored = warehouse.write(_shaped_entries(arrived), ENTRIES, batch_id, *ENTRY_FOLDERS)
    store_latency(warehouse, keypool.stored_rows(stored, "sync_latency_metrics"), batch_id)
    parts = (
        arrived.groupBy(F.col("log_file").alias("filename"), F.col("ord.part").alias("part"))
        .agg(F.max("file_size").alias("file_size"), F.min("ord").alias("ord"))
        .groupBy("filename")
        .agg(F.sum("file_size").alias("file_size"), F.min("ord").alias("ord"))
    )
    stats = keypool.file_stats_of_catalogue(parts, keypool.file_stats(stored))
    warehouse.write(keypool.ledger_rows(stats), "processed_files", batch_id)


def _shaped_entries(lines: DataFrame) -> DataFrame:
    """Parsed lines as they are stored: the text is kept of rejected ones alone."""
    return keypool.parse_lines(lines).withColumns(
        {
            "raw_line": F.when(F.col("reject_reason").isNotNull(), F.col("raw_line")),
            "log_type": F.coalesce("log_type", F.lit(NO_ENTRY)),
            DAY: F.to_date("timestamp"),
        }
    )


def entries_as_stream(warehouse: Warehouse, spark: SparkSession, max_files: int) -> DataFrame:
    """The keys of stored entries, as a stream over them. The folder is
    made where no batch has made it yet, as a stream needs one to look at."""
    line = spark.createDataFrame([], "value string, log_file string, file_size long, part string, block_start long")
    rows = with_arrival_order(line)
    shaped = _shaped_entries(rows.withColumn("ord", arrival(0, "ord.*")))
    if warehouse.read(spark, ENTRIES) is None:
        warehouse.write(shaped, ENTRIES, -1, *ENTRY_FOLDERS)
    plain = [f for f in shaped.schema.fields if f.name not in ENTRY_FOLDERS]
    folders = [T.StructField(BATCH, T.LongType()), *[shaped.schema[name] for name in ENTRY_FOLDERS]]
    return stream_key_rows(spark, warehouse, T.StructType(plain + folders), max_files)


def arrival(batch_id: int, *order: str) -> Column:
    """Arrival order in a stream: by batch, then by the order within it."""
    return F.struct(F.lit(batch_id).cast("long").alias("arrival"), *order)


def mark_empty_files(warehouse: Warehouse, catalogue: DataFrame) -> DataFrame:
    """Ledger rows with zeros of the files of size 0 in a catalogue; for `new_files`."""
    empty = catalogue.where("size = 0").select(
        "filename",
        *[F.lit(0).cast("long").alias(c) for c in FILE_LEDGER_COLUMNS if c != "filename"],
    )
    ledger = keypool_table(warehouse, catalogue.sparkSession, "processed_files")
    if ledger is None:
        return empty
    return ledger.select(*FILE_LEDGER_COLUMNS).unionByName(empty.join(ledger, "filename", "left_anti"))


def stored_entries(warehouse: Warehouse, spark: SparkSession) -> DataFrame | None:
    """Everything the key-pool pipeline has parsed."""
    entries = warehouse.read(spark, ENTRIES)
    if entries is None:
        return None
    return entries.withColumn("log_type", F.nullif("log_type", F.lit(NO_ENTRY)))


def keypool_table(warehouse: Warehouse, spark: SparkSession, table: str) -> DataFrame | None:
    """One of the four fact tables, or the file ledger."""
    if table in UPSERT_KEYS:
        return warehouse.folded(spark, keyed_table(warehouse, spark, table))
    entries = stored_entries(warehouse, spark)
    return None if entries is None else keypool.stored_rows(entries, table)


# ---------------------------------------------------------------- station


def in_parallel(spark: SparkSession, *writes: Callable[[], object]) -> None:
    """Run independent writes side by side, so that small ones fill the cluster; the
    first failure is raised when all have ended."""
    with ThreadPoolExecutor(len(writes)) as pool:
        for future in [pool.submit(inheritable_thread_target(spark)(write)) for write in writes]:
            future.result()


def known_packages(deliveries: DataFrame, ledger: DataFrame, batch_id: int) -> DataFrame:
    """What earlier batches have stored of the packages of a batch, one row per package."""
    day = F.col(PACKAGE_DAY)
    first, last = (deliveries.agg(edge(PACKAGE_DAY)).scalar() for edge in (F.min, F.max))
    flags = [c for c in ledger.columns if c.endswith("_done")]
    return (
        ledger.where((F.col(BATCH) != batch_id) & (day.between(first, last) | day.isNull()))
        .join(deliveries.select("package_timestamp"), "package_timestamp", "left_semi")
        .groupBy("package_timestamp")
        .agg(*[F.bool_or(c).alias(c) for c in flags])
    )


def without_stored_sections(
    settled: DataFrame, deliveries: DataFrame, ledger: DataFrame | None, batch_id: int
) -> DataFrame:
    """Empty the sections an earlier batch has stored for the same package.

    The ledger is cut by package day. The first and last day of the batch, read from one
    column of the stored deliveries, prune its folders before it is scanned, and only the
    batch's own packages leave the semi join.
    """
    if ledger is None:
        return settled
    known = known_packages(deliveries, ledger, batch_id)
    own = F.col("package_timestamp")
    joined = settled.withColumn("_name", spread_key(own, F.col("ord"))).join(
        known.withColumnRenamed("package_timestamp", "_name"), "_name", "left"
    )
    fresh = {
        s: F.when(own.isNull() | ~F.coalesce(F.col(f"{s}_done"), F.lit(False)), F.col(s))
        for s in SECTIONS
    }
    return joined.withColumns(fresh).select(*settled.columns)


def store_package_batch(warehouse: Warehouse, packages: DataFrame, batch_id: int) -> None:
    """Store a batch of deliveries, then what is new in them, table by table."""
    spark = packages.sparkSession
    # Settling sorts whole deliveries, a split of them per task. A stream has a session of its own.
    spark.conf.set("spark.sql.files.maxPartitionBytes", SETTLED_SPLIT)
    dated = packages.withColumns(
        {
            PACKAGE_DAY: F.to_date(package_time(F.col("package_timestamp"))),
            "ord": arrival(batch_id, F.col("ord").alias("delivery")),
        }
    )
    deliveries = warehouse.write(dated, "package_deliveries", batch_id, rows_per_file=DELIVERIES_PER_FILE)
    settled = station.settle(deliveries)
    ledger = warehouse.read(spark, "ogs_processed_packages")
    fresh = warehouse.write(
        without_stored_sections(settled, deliveries, ledger, batch_id), "settled_packages", batch_id
    )
    # Earlier batches are listed before the writes start: those replace what a failed run left.
    accepted = accepted_alerts(warehouse, deliveries, ledger, fresh, batch_id)
    in_parallel(
        spark,
        lambda: warehouse.write_by_day(
            station.environment_rows(fresh), "ogs_environment_data", batch_id, "timestamp"
        ),
        lambda: warehouse.write_by_day(station.link_rows(fresh), "ogs_link_data", batch_id, "timestamp"),
        lambda: warehouse.write(station.summary_rows(fresh), "ogs_pass_summary", batch_id),
        lambda: store_alerts(warehouse, accepted, batch_id),
        lambda: warehouse.write(station.schedule_rows(fresh), "ogs_pass_schedule", batch_id),
        lambda: merge_newest(warehouse, station.environment_rows(fresh), "ogs_environment_data", batch_id),
        lambda: merge_newest(warehouse, station.link_rows(fresh), "ogs_link_data", batch_id),
    )
    known = None if ledger is None else known_packages(deliveries, ledger, batch_id)
    warehouse.write(batch_counters(deliveries, known), COUNTERS, batch_id)
    done = (
        station.package_status(deliveries)
        .groupBy("package_timestamp")
        .agg(F.bool_or(F.coalesce("package_ok", F.lit(False))).alias("package_done"))
    )
    marked = (
        station.package_ledger(fresh)
        .join(done, "package_timestamp")
        .withColumn(PACKAGE_DAY, F.to_date(package_time(F.col("package_timestamp"))))
    )
    # The ledger comes last: a batch counts as done when everything else is written.
    warehouse.write(marked, "ogs_processed_packages", batch_id, PACKAGE_DAY)


def accepted_alerts(
    warehouse: Warehouse, deliveries: DataFrame, ledger: DataFrame | None, fresh: DataFrame, batch_id: int
) -> DataFrame:
    """The alerts of a batch whose pass is known on arrival, or that name none.

    Decided once, when the batch is stored: a pass that comes later, in whatever file, does
    not let in an alert that was refused, and compaction changes nothing.
    """
    spark = deliveries.sparkSession
    known = None if ledger is None else known_packages(deliveries, ledger, batch_id)
    passes = station.first_seen_passes(station.summary_rows(fresh), warehouse.collation)
    earlier = warehouse.state(spark, keyed_table(warehouse, spark, "ogs_pass_summary"), upto=batch_id - 1)
    if earlier is not None:
        both = passes.unionByName(earlier.select(F.col(KEY).alias("pass_id"), FIRST_ORD))
        passes = both.groupBy("pass_id").agg(F.min(FIRST_ORD).alias(FIRST_ORD))
    return station.linked_alerts(station.offered_alerts(deliveries, known), passes, warehouse.collation)


def store_alerts(warehouse: Warehouse, accepted: DataFrame, batch_id: int) -> None:
    """Store a batch of accepted alerts, and those of them that are in the table from now on.

    The table keeps the first alert of an id. Which one that is shows when it arrives, so the
    alerts that enter the table are stored by day and merged into the newest ones; a view of
    them folds nothing. Of earlier batches only the ids are read, and only the batch's own ids
    leave the join.
    """
    spark = accepted.sparkSession
    stored = warehouse.write(accepted, "ogs_alerts", batch_id)
    first = fold(
        stored.drop(station.DELIVERY), UPSERT_KEYS["ogs_alerts"], collation=warehouse.collation, with_order=True
    ).withColumnRenamed(FIRST_ORD, "ord").drop(LAST_ORD)
    key = collated(F.col("alert_id"), warehouse.collation).alias(KEY)
    earlier = warehouse.read(spark, "ogs_alerts").where(F.col(BATCH) < batch_id).select(key)
    known = earlier.join(first.select(key), KEY, "left_semi").distinct()
    entering = first.withColumn(KEY, key).join(known, KEY, "left_anti").drop(KEY)
    warehouse.write_by_day(entering, ENTERED_ALERTS, batch_id, "timestamp")
    written = spark.read.schema(by_day(entering).schema).parquet(warehouse.folder(ENTERED_ALERTS, batch_id))
    merge_newest(warehouse, written.drop(DAY), "ogs_alerts", batch_id)


def entered_alerts(warehouse: Warehouse, spark: SparkSession) -> DataFrame | None:
    """The alerts of the table, cut by day, each as it entered."""
    rows = warehouse.read(spark, ENTERED_ALERTS)
    return None if rows is None else rows.drop(BATCH)


def package_ledger(warehouse: Warehouse, spark: SparkSession) -> DataFrame | None:
    """One row per package over all batches."""
    rows = warehouse.read(spark, "ogs_processed_packages")
    return None if rows is None else ledger_of(rows)


def ledger_of(rows: DataFrame) -> DataFrame:
    """The package ledger out of the rows of some batches."""
    return rows.groupBy("package_timestamp").agg(
        F.min_by("collector_id", BATCH).alias("collector_id"),
        F.sum("deliveries").alias("deliveries"),
        F.sum("records_inserted").alias("records_inserted"),
        *[F.bool_or(f"{s}_done").alias(f"{s}_done") for s in SECTIONS],
    )


def station_table(warehouse: Warehouse, spark: SparkSession, table: str) -> DataFrame | None:
    """One of the station tables, keyed tables folded."""
    if table in UPSERT_KEYS:
        return warehouse.folded(spark, keyed_table(warehouse, spark, table), with_order=True)
    rows = warehouse.read(spark, table)
    return None if rows is None else rows.drop(BATCH)


# ---------------------------------------------------------------- keyed tables


def keyed_table(warehouse: Warehouse, spark: SparkSession, table: str) -> KeyedTable:
    """How a keyed table folds out of what the pipelines have stored."""
    key, replaces = UPSERT_KEYS[table], UPSERT_REPLACES[table]
    if table == "key_creations":
        return KeyedTable(table, key, replaces, "log_entries", lambda rows: keypool.stored_rows(rows, table))
    if table == "ogs_alerts":
        return KeyedTable(table, key, replaces, table, lambda rows: without_batch(rows).drop(station.DELIVERY))
    return KeyedTable(table, key, replaces, table)


def compact(warehouse: Warehouse, spark: SparkSession) -> dict[str, int | None]:
    """Snapshot every keyed table; gives the newest batch each covers."""
    return {name: warehouse.compact(spark, keyed_table(warehouse, spark, name)) for name in UPSERT_KEYS}


# How the tables of batches are cut, so that merged batches are cut alike.
BATCH_TABLES = {
    ENTRIES: ENTRY_FOLDERS,
    "processed_files": (),
    "package_deliveries": (),
    "settled_packages": (),
    "ogs_environment_data": (DAY,),
    "ogs_link_data": (DAY,),
    "ogs_pass_summary": (),
    "ogs_alerts": (),
    ENTERED_ALERTS: (DAY,),
    "ogs_pass_schedule": (),
    "ogs_processed_packages": (PACKAGE_DAY,),
    COUNTERS: (),
    rollups.KEY_ENDS.source: (),
    rollups.CHANGES: ("date",),
}


def merge_batches(warehouse: Warehouse, spark: SparkSession, followed: bool = False) -> dict[str, int | None]:
    """Merge the whole batches of every table; gives the newest batch its segments stand for.

    `followed`: the rollup pipeline reads the log entries, so their batches stay for it.
    """
    return {
        name: warehouse.merge(spark, name, *cut, remove=not (followed and name == ENTRIES))
        for name, cut in BATCH_TABLES.items()
    }
