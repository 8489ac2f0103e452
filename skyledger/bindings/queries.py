"""The registered queries: operators applied to the log lines and packages of `events`."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skyledger.bindings import log_files, stand_ins
from skyledger.operators import assemble, keypool, quality, station
from skyledger.operators.asof import Series
from skyledger.plans import export, panels, views
from skyledger.schemas import FILE_LEDGER_COLUMNS, KEYPOOL_TABLES, STATION_TABLES
from skyledger.session import scratch_folder
from skyledger.sources import catalogue
from skyledger.sources.logs import read_log_lines, stream_log_lines
from skyledger.sources.packages import package_line_batch, parse_documents, stream_package_lines
from skyledger.sources.tables import read_table, write_by_day
from skyledger.streaming.ingest import (
    compact,
    entered_alerts,
    entries_as_stream,
    keypool_table,
    package_ledger,
    station_table,
    store_log_batch,
    store_package_batch,
)
from skyledger.streaming import checks, dedup, dumps, rollups
from skyledger.streaming.newest import newest_rows
from skyledger.streaming.progress import ingest_counters as ingest_counters_of
from skyledger.streaming.rollups import compact_daily, daily_table, store_key_changes
from skyledger.streaming.service import start_ingest
from skyledger.streaming.warehouse import Warehouse

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}

# Moments the queries refer to; all lie inside the events.
LEDGER_CUT = "2024-01-16 12:00:00"
AS_OF = "2024-01-16 00:00:00"
RANGE = ("2024-01-10 00:00:00", "2024-01-20 00:00:00")
WANTED_PACKAGE = "package_20240101_000500.json"
SERIES_DAY = ("2024-01-15 00:00:00", "2024-01-15 23:59:50")


def query(function: Query) -> Query:
    REGISTRY[function.__name__] = function
    return function


# ---------------------------------------------------------------- inputs


def _entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keypool.parse_lines(stand_ins.log_lines(spark, sf_dir))


def _settled(spark: SparkSession, sf_dir: str, *sections: str) -> DataFrame:
    return station.settle(stand_ins.packages(spark, sf_dir, *sections))


def _environment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return station.environment_rows(_settled(spark, sf_dir, "environment"))


def _link(spark: SparkSession, sf_dir: str) -> DataFrame:
    return station.link_rows(_settled(spark, sf_dir, "link"))


def _passes(spark: SparkSession, sf_dir: str, with_order: bool = False) -> DataFrame:
    rows = station.summary_rows(_settled(spark, sf_dir, "summary"))
    return station.pass_summary(rows, with_order=with_order)


def _alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    passes = station.first_seen_passes(station.summary_rows(_settled(spark, sf_dir, "summary")))
    occurrences = station.offered_alerts(stand_ins.packages(spark, sf_dir, *station.CHECKED_SECTIONS))
    stored = station.alerts(occurrences, passes, with_order=True)
    return stored.withColumnRenamed("first_ord", "ord").drop("last_ord")


def _schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    return station.pass_schedule(station.schedule_rows(_settled(spark, sf_dir, "schedule")))


def _log_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = stand_ins.log_lines(spark, sf_dir)
    return lines.groupBy(F.col("log_file").alias("filename")).agg(
        F.sum(F.octet_length("value") + 1).alias("file_size")
    )


def _ledger_run(spark: SparkSession, sf_dir: str, run: int, before: str | None) -> DataFrame:
    """Ledger rows of one pass over the files, as they were at that moment."""
    lines = stand_ins.log_lines(spark, sf_dir, before)
    sizes = lines.groupBy(F.col("log_file").alias("filename")).agg(
        F.sum(F.octet_length("value") + 1).alias("file_size")
    )
    stats = keypool.file_stats(keypool.parse_lines(lines)).join(sizes, "filename")
    return keypool.ledger_rows(stats.withColumn("ord", F.lit(run)))


# ---------------------------------------------------------------- key pool


@query
def log_classify_counts(spark, sf_dir):
    return (
        _entries(spark, sf_dir)
        .groupBy(F.coalesce("log_type", F.lit("NO_ENTRY")).alias("log_type"))
        .agg(F.count(F.lit(1)).alias("lines"))
    )


@query
def log_header_fields(spark, sf_dir):
    return _entries(spark, sf_dir).select(
        "ord", "log_file", F.col("time_text"), "site_id", "log_type", "raw_line"
    )


@query
def key_creation_parse(spark, sf_dir):
    return keypool.stored_rows(_entries(spark, sf_dir), "key_creations")


@query
def sync_latency_parse(spark, sf_dir):
    return keypool.stored_rows(_entries(spark, sf_dir), "sync_latency_metrics")


@query
def key_count_parse(spark, sf_dir):
    return keypool.stored_rows(_entries(spark, sf_dir), "key_count_metrics")


@query
def controller_sync_parse(spark, sf_dir):
    return keypool.stored_rows(_entries(spark, sf_dir), "controller_syncs")


@query
def rejected_lines(spark, sf_dir):
    return keypool.rejected_lines(_entries(spark, sf_dir))


@query
def file_stats(spark, sf_dir):
    stats = keypool.file_stats(_entries(spark, sf_dir))
    return keypool.file_stats_of_catalogue(_log_catalogue(spark, sf_dir), stats)


@query
def key_creation_upsert(spark, sf_dir):
    return keypool.key_creations(_entries(spark, sf_dir))


@query
def file_ledger_upsert(spark, sf_dir):
    early = _ledger_run(spark, sf_dir, 1, LEDGER_CUT)
    late = _ledger_run(spark, sf_dir, 2, None)
    return keypool.file_ledger(early.unionByName(late))


@query
def new_files(spark, sf_dir):
    ledger = _ledger_run(spark, sf_dir, 1, LEDGER_CUT)
    return catalogue.new_files(_log_catalogue(spark, sf_dir), ledger)


@query
def key_creation_summary(spark, sf_dir):
    return views.key_creation_summary(keypool.key_creations(_entries(spark, sf_dir)))


@query
def latency_stats(spark, sf_dir):
    return views.latency_stats(keypool.stored_rows(_entries(spark, sf_dir), "sync_latency_metrics"))


@query
def daily_key_production(spark, sf_dir):
    return views.daily_key_production(keypool.key_creations(_entries(spark, sf_dir)))


# ---------------------------------------------------------------- station tables


@query
def env_flatten(spark, sf_dir):
    return _environment(spark, sf_dir)


@query
def link_flatten(spark, sf_dir):
    return _link(spark, sf_dir)


@query
def pass_summary_upsert(spark, sf_dir):
    return _passes(spark, sf_dir)


@query
def alerts_ignore_fk(spark, sf_dir):
    return _alerts(spark, sf_dir).drop("ord")


@query
def schedule_flatten(spark, sf_dir):
    rows = station.schedule_rows(_settled(spark, sf_dir, "schedule"))
    return rows.select(F.col("ord.delivery_ord").alias("ord"), F.col("ord.pos").alias("pos"), *STATION_TABLES["ogs_pass_schedule"])


@query
def schedule_upsert(spark, sf_dir):
    return _schedule(spark, sf_dir)


@query
def collector_status(spark, sf_dir):
    return station.collector_rows(stand_ins.packages(spark, sf_dir, "environment"))


@query
def package_dedup(spark, sf_dir):
    return station.settled_order(stand_ins.packages(spark, sf_dir)).select(
        "package_timestamp",
        "file_name",
        "ord",
        "deliveries",
        *[f"{s}_ord" for s in ("environment", "link", "summary", "alerts", "schedule")],
    )


@query
def package_ledger_rows(spark, sf_dir):
    return station.package_ledger(station.settle(station.bare_sections(stand_ins.packages(spark, sf_dir))))


@query
def package_status(spark, sf_dir):
    return station.package_status(stand_ins.packages(spark, sf_dir, *station.CHECKED_SECTIONS))


@query
def ingest_counters(spark, sf_dir):
    return station.ingest_counters(stand_ins.packages(spark, sf_dir, *station.CHECKED_SECTIONS))


@query
def rejected_sections(spark, sf_dir):
    return quality.rejected_sections(stand_ins.packages(spark, sf_dir))


@query
def rejected_items(spark, sf_dir):
    return quality.rejected_items(_settled(spark, sf_dir, "alerts", "schedule")).select(
        "table",
        F.col("ord.delivery_ord").alias("ord"),
        F.col("ord.pos").alias("pos"),
        F.array_join("missing", ",").alias("missing"),
    )


# ---------------------------------------------------------------- views and panels


@query
def latest_environment(spark, sf_dir):
    return views.latest_environment(_environment(spark, sf_dir))


@query
def latest_link(spark, sf_dir):
    return views.latest_link(_link(spark, sf_dir))


@query
def recent_passes(spark, sf_dir):
    return views.recent_passes(_passes(spark, sf_dir, with_order=True))


@query
def active_alerts(spark, sf_dir):
    return views.active_alerts(_alerts(spark, sf_dir), AS_OF)


@query
def temperature_series(spark, sf_dir):
    return panels.temperature_series(_environment(spark, sf_dir), *RANGE)


@query
def wind_series(spark, sf_dir):
    return panels.wind_series(_environment(spark, sf_dir), *RANGE)


@query
def qber_series(spark, sf_dir):
    return panels.qber_series(_link(spark, sf_dir), *RANGE)


@query
def qber_latest_band(spark, sf_dir):
    return panels.latest_qber(_link(spark, sf_dir))


@query
def dome_status_now(spark, sf_dir):
    return panels.dome_status(_environment(spark, sf_dir))


@query
def recent_alerts_coloured(spark, sf_dir):
    return panels.recent_alerts(_alerts(spark, sf_dir))


@query
def recent_alert_buffer(spark, sf_dir):
    return station.recent_alert_buffer(_alerts(spark, sf_dir))


# ---------------------------------------------------------------- packages and files


@query
def package_catalogue(spark, sf_dir):
    return catalogue.package_list(stand_ins.package_documents(spark, sf_dir))


def _package_head(packages: DataFrame) -> DataFrame:
    return parse_documents(packages, ["environment"]).select(
        "file_name",
        "package_timestamp",
        "collector_id",
        "ogs_provider",
        F.col("environment.weather.temperature_c").alias("temperature"),
        F.col("logs.total_fetches").alias("total_fetches"),
    )


@query
def latest_package(spark, sf_dir):
    return _package_head(catalogue.latest_package(stand_ins.package_documents(spark, sf_dir)))


@query
def package_by_name(spark, sf_dir):
    documents = stand_ins.package_documents(spark, sf_dir)
    return _package_head(catalogue.package_by_name(documents, WANTED_PACKAGE))


@query
def package_assemble(spark, sf_dir):
    """The newest state of every section, assembled into a document and read back."""
    warehouse = _station_tables(spark, sf_dir)
    tables = {n: warehouse(n) for n in ("environment", "link", "summary", "alerts", "schedule", "collector")}
    document = assemble.snapshot(
        tables["environment"], tables["link"], tables["summary"], tables["alerts"],
        tables["schedule"], tables["collector"], AS_OF,
    )
    return _package_summary(document)


@query
def package_series(spark, sf_dir):
    """The documents of every ten seconds of a day, each as of its moment, read back."""
    tables = _station_tables(spark, sf_dir)
    names = ("environment", "link", "summary", "alerts", "schedule", "collector")
    documents = assemble.package_series(*map(tables, names), Series(*SERIES_DAY))
    return _package_summary(documents)


def _package_summary(documents: DataFrame) -> DataFrame:
    package = parse_documents(documents.withColumn("ord", F.lit(0)))
    alerts, plan = F.col("alerts.alerts"), F.col("schedule.scheduled_passes")
    return package.select(
        "file_name",
        "package_timestamp",
        "collector_id",
        F.col("environment.timestamp").alias("environment_time"),
        F.col("environment.weather.temperature_c").alias("temperature"),
        F.col("environment.dome_status.is_open").alias("dome_open"),
        F.col("link.pass_id").alias("link_pass"),
        F.col("link.link_status.quantum.qber").alias("qber"),
        F.col("summary.pass_id").alias("summary_pass"),
        F.col("summary.key_distillation.keys_distilled").alias("keys_distilled"),
        F.col("alerts.count").alias("alert_count"),
        F.array_join(F.transform(alerts, lambda a: F.concat_ws(" ", a["timestamp"], a["description"])), ";").alias("alerts"),
        F.array_join(F.transform(plan, lambda p: F.concat_ws(" ", p["pass_id"], p["start_time"])), ";").alias("planned"),
    )


def _station_tables(spark: SparkSession, sf_dir: str) -> Callable[[str], DataFrame]:
    """The inputs of a snapshot, written once so that its sections do not re-parse. Of the
    deliveries only what alerts and collector rows are made of is written."""
    root = scratch_folder(spark, "snapshot")

    def written(rows: DataFrame, name: str) -> DataFrame:
        rows.write.parquet(f"{root}/{name}")
        return read_table(spark, f"{root}/{name}")

    parsed = stand_ins.packages(spark, sf_dir)
    settled = written(station.settle(parsed), "settled")
    bare = station.bare_sections(parsed, "environment", "link", "summary").drop("schedule")
    packages = written(bare, "deliveries")
    summaries = station.summary_rows(settled)
    offered, passes = station.offered_alerts(packages), station.first_seen_passes(summaries)
    stored = written(station.alerts(offered, passes, with_order=True), "alerts")
    tables = {
        "settled": settled,
        "environment": station.environment_rows(settled),
        "link": station.link_rows(settled),
        "summary": summaries,
        "alerts": stored.withColumnRenamed("first_ord", "ord"),
        "schedule": station.schedule_rows(settled),
        "collector": station.collector_rows(packages),
    }
    return tables.__getitem__


@query
def table_stats(spark, sf_dir):
    """Rows of every table; lines and packages are parsed once and stored."""
    path = scratch_folder(spark, "entries")
    _entries(spark, sf_dir).write.parquet(path)
    entries = read_table(spark, path)
    tables = {name: keypool.stored_rows(entries, name) for name in KEYPOOL_TABLES if name != "key_creations"}
    tables["key_creations"] = keypool.key_creations(entries)
    station_rows = _station_tables(spark, sf_dir)
    tables |= {
        "ogs_environment_data": station_rows("environment"),
        "ogs_link_data": station_rows("link"),
        "ogs_pass_summary": station.pass_summary(station_rows("summary")),
        "ogs_alerts": station_rows("alerts"),
        "ogs_pass_schedule": station.pass_schedule(station_rows("schedule")),
        "ogs_processed_packages": station.package_ledger(station_rows("settled")),
    }
    return export.table_stats(tables)


@query
def export_roundtrip(spark, sf_dir):
    """Pass summaries through a CSV export and back."""
    path = scratch_folder(spark, "export")
    rows = _passes(spark, sf_dir)
    export.export_csv(rows, path)
    return export.read_csv(spark, path, rows.schema)


@query
def dump_restore(spark, sf_dir):
    """Alerts through a table dump and back."""
    path = scratch_folder(spark, "dump")
    export.dump({"ogs_alerts": _alerts(spark, sf_dir).drop("ord")}, path)
    return export.restore(spark, path, "ogs_alerts")


@query
def day_table_scan(spark, sf_dir):
    """Link readings stored by day, then the newest of them through day pruning."""
    path = scratch_folder(spark, "by-day")
    write_by_day(_link(spark, sf_dir), path)
    return views.latest_link(read_table(spark, path))


@query
def log_catalogue(spark, sf_dir):
    """The log files on disk with their sizes."""
    path = _write_log_files(spark, sf_dir)
    return catalogue.log_catalogue(spark, path, folder="log_file").drop("modified")


@query
def log_listing(spark, sf_dir):
    """Log files as single files in two folders, with equal names and empty ones among them:
    all lines in one, those of the broken kind in the other."""
    root = scratch_folder(spark, "listing")
    lines = stand_ins.log_lines(spark, sf_dir)
    names = lines.select("log_file").distinct()
    broken = lines.where(~F.col("value").contains("METRIC") & ~F.col("value").contains("createKey"))
    for folder, rows in (("all", lines), ("other", broken)):
        log_files.write_files(rows, names, f"{root}/site/{folder}")
    listed = catalogue.list_files(spark, root, "*.log")
    folder = F.element_at(F.split("path", "/"), -2)
    return listed.select(folder.alias("folder"), "filename", "size")


@query
def log_file_scan(spark, sf_dir):
    """Latency per day from log files on disk, numbered in file order."""
    path = _write_log_files(spark, sf_dir)
    entries = keypool.parse_lines(read_log_lines(spark, path, glob=None, folder="log_file"))
    return keypool.key_creations(entries)


def _write_log_files(spark: SparkSession, sf_dir: str) -> str:
    """The log lines as a landing folder, one folder per log, parts in line order."""
    path = scratch_folder(spark, "logs")
    _write_log_lines(stand_ins.log_lines(spark, sf_dir), path)
    return path


def _write_log_lines(lines: DataFrame, path: str) -> None:
    (
        lines.repartitionByRange("ord")
        .sortWithinPartitions("log_file", "ord")
        .select("log_file", "value")
        .write.mode("append")
        .partitionBy("log_file")
        .text(path)
    )


# ---------------------------------------------------------------- streams

_RUNS: dict[tuple, Warehouse] = {}


def _once(spark: SparkSession, sf_dir: str, name: str, run: Callable[[], Warehouse]) -> Warehouse:
    """The tables of a stream run, shared by the queries of a session that read them."""
    key = (spark.sparkContext.applicationId, sf_dir, name, stand_ins.version(spark, sf_dir))
    if key not in _RUNS:
        _RUNS[key] = run()
    return _RUNS[key]


def _log_stream(spark: SparkSession, sf_dir: str) -> Warehouse:
    def run() -> Warehouse:
        landing = _write_log_files(spark, sf_dir)
        root = scratch_folder(spark, "stream")
        warehouse = Warehouse(f"{root}/tables")
        lines = stream_log_lines(spark, landing, max_files=10_000, glob=None, folder="log_file")
        start_ingest(lines, store_log_batch, warehouse, f"{root}/progress", "keypool").awaitTermination()
        return warehouse

    return _once(spark, sf_dir, "logs", run)


def _rollup_run(spark: SparkSession, sf_dir: str) -> Warehouse:
    """The daily views after three landings of log files, in the order of their names, each
    taken in and rolled up before the next; most keys repeat from one to the next."""

    def run() -> Warehouse:
        root = scratch_folder(spark, "stream")
        warehouse = Warehouse(f"{root}/tables")
        lines = stand_ins.log_lines(spark, sf_dir)
        third = F.ntile(3).over(Window.partitionBy().orderBy("log_file"))
        thirds = lines.select("log_file").distinct().withColumn("third", third)
        for number in (1, 2, 3):
            # The names are few; without the hint all lines would be shuffled to meet them.
            names = F.broadcast(thirds.where(F.col("third") == number))
            part = lines.join(names, "log_file", "left_semi")
            _write_log_lines(part, f"{root}/landing")
            landed = stream_log_lines(spark, f"{root}/landing", max_files=10_000, glob=None, folder="log_file")
            start_ingest(landed, store_log_batch, warehouse, f"{root}/progress", "keypool").awaitTermination()
            keys = entries_as_stream(warehouse, spark, max_files=10_000)
            rolled = start_ingest(keys, store_key_changes, warehouse, f"{root}/rollup-progress", "rollups")
            rolled.awaitTermination()
            if number == 2:
                compact_daily(warehouse, spark)
        return warehouse

    return _once(spark, sf_dir, "rollups", run)


def _store_merged(warehouse: Warehouse, lines: DataFrame, batch_id: int) -> None:
    store_package_batch(warehouse, package_line_batch(lines), batch_id)


def _package_stream(spark: SparkSession, sf_dir: str, compacted: bool = False) -> Warehouse:
    """The station tables after three landings of merged files; with `compacted` after
    snapshots between and behind them."""

    def run() -> Warehouse:
        root = scratch_folder(spark, "stream")
        warehouse = Warehouse(f"{root}/tables")
        for third in range(3):
            # A landing is one micro-batch.
            stand_ins.land_documents(spark, sf_dir, f"{root}/landing", third)
            lines = stream_package_lines(spark, f"{root}/landing", max_files=10_000)
            start_ingest(lines, _store_merged, warehouse, f"{root}/progress", "station").awaitTermination()
            if compacted:
                compact(warehouse, spark)
        return warehouse

    return _once(spark, sf_dir, f"packages-{compacted}", run)


def _streamed(name: str, table: str, compacted: bool = False) -> None:
    def read(spark, sf_dir):
        warehouse = _package_stream(spark, sf_dir, compacted)
        return station_table(warehouse, spark, table).select(*STATION_TABLES[table])

    read.__name__, read.__doc__ = name, f"{table} as the streaming pipeline stores it."
    query(read)


def _streamed_log(name: str, table: str, columns: list[str]) -> None:
    def read(spark, sf_dir):
        return keypool_table(_log_stream(spark, sf_dir), spark, table).select(*columns)

    read.__name__, read.__doc__ = name, f"{table} as the streaming pipeline stores it."
    query(read)


_streamed_log("stream_log_ingest", "key_creations", KEYPOOL_TABLES["key_creations"])
_streamed_log("stream_sync_latency", "sync_latency_metrics", KEYPOOL_TABLES["sync_latency_metrics"])
_streamed_log("stream_key_count", "key_count_metrics", KEYPOOL_TABLES["key_count_metrics"])
_streamed_log("stream_controller_sync", "controller_syncs", KEYPOOL_TABLES["controller_syncs"])
_streamed_log("stream_file_ledger", "processed_files", FILE_LEDGER_COLUMNS)
_streamed("stream_package_ingest", "ogs_pass_summary")
_streamed("stream_alert_ingest", "ogs_alerts")
_streamed("stream_environment", "ogs_environment_data")
_streamed("stream_link", "ogs_link_data")
_streamed("stream_schedule", "ogs_pass_schedule")
_streamed("stream_compact_passes", "ogs_pass_summary", compacted=True)
_streamed("stream_compact_alerts", "ogs_alerts", compacted=True)
_streamed("stream_compact_schedule", "ogs_pass_schedule", compacted=True)


@query
def stream_package_ledger(spark, sf_dir):
    """The package ledger after the streaming pipeline has run."""
    return package_ledger(_package_stream(spark, sf_dir), spark)


# Views and panels of the newest rows, from the states the pipeline keeps for them.


def _newest_view(name: str, table: str, view: Callable[[DataFrame], DataFrame]) -> None:
    def read(spark, sf_dir):
        return view(newest_rows(_package_stream(spark, sf_dir), spark, table))

    read.__name__, read.__doc__ = name, f"{view.__name__} over the newest rows of {table} kept by the streaming pipeline."
    query(read)


_newest_view("stream_latest_environment", "ogs_environment_data", views.latest_environment)
_newest_view("stream_latest_link", "ogs_link_data", views.latest_link)
_newest_view("stream_qber_latest", "ogs_link_data", panels.latest_qber)
_newest_view("stream_dome_status", "ogs_environment_data", panels.dome_status)
_newest_view("stream_recent_alerts", "ogs_alerts", panels.recent_alerts)
_newest_view("stream_alert_buffer", "ogs_alerts", station.recent_alert_buffer)


@query
def stream_active_alerts(spark, sf_dir):
    """The active alerts from the days they were stored by, with nothing folded."""
    return views.active_alerts(entered_alerts(_package_stream(spark, sf_dir), spark), AS_OF)


@query
def stream_ingest_counters(spark, sf_dir):
    """The counters of the station pipeline, summed over its batches."""
    return ingest_counters_of(_package_stream(spark, sf_dir), spark)


@query
def stream_package_dedup(spark, sf_dir):
    """The packages a stream takes in as first whole deliveries, with state for one hour of them.

    The third landing brings again what the second one ended with, which the state still
    knows, and all of the first, which is older than the watermark.
    """

    def run() -> Warehouse:
        root = scratch_folder(spark, "stream")
        documents = stand_ins.package_documents(spark, sf_dir).withColumn("pair", F.floor(F.col("ord") / 2))
        third = F.floor(F.col("pair") * 3 / documents.agg(F.max("pair") + 1).scalar())
        for number in range(3):
            part = documents.where(third <= number) if number == 2 else documents.where(third == number)
            part.select("document").write.mode("append").option("compression", "gzip").text(f"{root}/landing")
            lines = stream_package_lines(spark, f"{root}/landing", max_files=10_000)
            packages = parse_documents(
                lines.select(F.col("log_file").alias("file_name"), F.lit(0).alias("ord"), F.col("value").alias("document")),
                station.CHECKED_SECTIONS,
            )
            taken = dedup.first_within(dedup.complete_deliveries(packages).select("package_timestamp"), "1 hour")
            writer = taken.writeStream.option("checkpointLocation", f"{root}/progress").trigger(availableNow=True)
            writer.start(f"{root}/packages", format="parquet").awaitTermination()
        return Warehouse(root)

    return read_table(spark, _once(spark, sf_dir, "dedup", run).folder("packages")).select("package_timestamp")


def _checked_stream(spark: SparkSession, sf_dir: str) -> Warehouse:
    """Key creations through an export and back as a stream, some with a pool type nobody knows
    and some without their key, in three landings."""

    def run() -> Warehouse:
        root = scratch_folder(spark, "stream")
        warehouse = Warehouse(f"{root}/tables")
        rows = keypool.stored_rows(_entries(spark, sf_dir), "key_creations")
        order = F.col("ord")
        rows = rows.withColumns(
            {
                "key_pool_type": F.when(order % 17 == 0, "FOREIGN").otherwise(F.col("key_pool_type")),
                "key_identity": F.when(order % 23 != 0, F.col("key_identity")),
            }
        )
        store = lambda warehouse, batch, batch_id: checks.store_checked(warehouse, batch, "key_creations", batch_id)
        for number in range(3):
            rows.where(order % 3 == number).write.mode("append").csv(f"{root}/landing")
            landed = spark.readStream.schema(rows.schema).csv(f"{root}/landing")
            start_ingest(landed, store, warehouse, f"{root}/progress", "import").awaitTermination()
        return warehouse

    return _once(spark, sf_dir, "checked", run)


@query
def stream_quarantine(spark, sf_dir):
    """The rows that the checks of a stream have refused, with what is wrong with them."""
    refused = checks.quarantined_rows(_checked_stream(spark, sf_dir), spark, "key_creations")
    return refused.select("ord", "key_identity", "key_pool_type", F.array_join("violations", ",").alias("violations"))


@query
def stream_violation_counts(spark, sf_dir):
    """The violations as observed while the batches were written."""
    return checks.violation_counts(_checked_stream(spark, sf_dir), spark, "key_creations").where("rows > 0")


@query
def stream_dump_stats(spark, sf_dir):
    """Rows of the station tables restored from a dump of the streamed warehouse."""
    path = scratch_folder(spark, "dump")
    dumps.dump_all(_package_stream(spark, sf_dir), spark, path)
    names = dict.fromkeys([*dumps.STATION_NAMES, dumps.LAST_WRITTEN["station"]])
    return export.table_stats({name: export.restore(spark, path, name) for name in names})


# The daily views, from the tables that each micro-batch brings up to date.


def _daily_view(name: str, table: str, view: Callable[[DataFrame], DataFrame]) -> None:
    def read(spark, sf_dir):
        return view(daily_table(_rollup_run(spark, sf_dir), spark, table))

    read.__name__, read.__doc__ = name, f"{view.__name__} as kept from changes by the rollup pipeline."
    query(read)


_daily_view("stream_key_summary", rollups.SUMMARY.name, rollups.key_creation_summary)
_daily_view("stream_daily_production", rollups.PRODUCTION.name, rollups.daily_key_production)
_daily_view("stream_latency_stats", rollups.LATENCY, rollups.latency_stats)
