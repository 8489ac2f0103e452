"""Running the pipelines: triggers, on/off flags, restarts, progress."""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from skyledger.config import Settings
from skyledger.sources.logs import stream_log_lines
from skyledger.sources.packages import stream_packages
from skyledger.streaming.ingest import compact, entries_as_stream, merge_batches, store_log_batch, store_package_batch
from skyledger.streaming.progress import ProgressLog
from skyledger.streaming.rollups import DAILY_TABLES, KEY_ENDS, compact_daily, store_key_changes
from skyledger.streaming.warehouse import Warehouse

# Attempts after a failure and the pause between them.
ATTEMPTS = 3
PAUSE_SECONDS = 2

# The pipelines that take in what lands, and those that read what these have stored.
LANDINGS, VIEWS = ("keypool", "station"), ("rollups",)
PIPELINES = LANDINGS + VIEWS

StoreBatch = Callable[[Warehouse, DataFrame, int], None]


def start_ingest(
    stream: DataFrame,
    store: StoreBatch,
    warehouse: Warehouse,
    checkpoint: str,
    name: str,
    interval: str | None = None,
) -> StreamingQuery:
    """Start one pipeline. Without an interval it takes what is there and ends."""
    # Each pipeline has its own pool, so a long batch of one does not hold up the other. A
    # query keeps the pool of the thread that started it; the caller's own stays as it was.
    context = stream.sparkSession.sparkContext
    pool = context.getLocalProperty("spark.scheduler.pool")
    writer = (
        stream.writeStream.queryName(name)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(lambda batch, batch_id: store(warehouse, batch, batch_id))
    )
    trigger = {"availableNow": True} if interval is None else {"processingTime": interval}
    context.setLocalProperty("spark.scheduler.pool", name)
    try:
        return writer.trigger(**trigger).start()
    finally:
        context.setLocalProperty("spark.scheduler.pool", pool)


def progress(query: StreamingQuery) -> dict:
    """Batches and rows of the recent progress reports, and the time of the last one."""
    reports = [r for r in query.recentProgress if r["numInputRows"] > 0]
    return {
        "batches": len(reports),
        "rows": sum(r["numInputRows"] for r in reports),
        "last_process": reports[-1]["timestamp"] if reports else None,
    }


@dataclass
class IngestService:
    """The enabled pipelines of a deployment, each an independent streaming query."""

    spark: SparkSession
    settings: Settings
    queries: dict[str, StreamingQuery] = field(default_factory=dict)
    failures: dict[str, str] = field(default_factory=dict)
    restarts: dict[str, int] = field(default_factory=dict)
    log: ProgressLog | None = None

    @property
    def warehouse(self) -> Warehouse:
        return Warehouse(self.settings.warehouse, self.settings.collation)

    def _start(self, name: str, continuous: bool) -> StreamingQuery:
        pipeline = getattr(self.settings, name)
        files = pipeline.max_files_per_trigger
        if name == "rollups":
            stream, store = entries_as_stream(self.warehouse, self.spark, files), store_key_changes
        else:
            source, store = {
                "keypool": (stream_log_lines, store_log_batch),
                "station": (stream_packages, store_package_batch),
            }[name]
            stream = source(self.spark, pipeline.landing, files, archive=pipeline.archive)
        return start_ingest(
            stream,
            store,
            self.warehouse,
            f"{self.settings.checkpoints}/{name}",
            name,
            pipeline.interval if continuous else None,
        )

    def start(self, continuous: bool = True, names: tuple[str, ...] = PIPELINES) -> dict[str, StreamingQuery]:
        """Start every enabled pipeline. One that cannot start does not stop the others."""
        for name in names:
            if not getattr(self.settings, name).enabled:
                continue
            try:
                self.queries[name] = self._start(name, continuous)
            except Exception as error:  # noqa: BLE001 - recorded, the others go on
                self.failures[name] = str(error)
        return self.queries

    def supervise(self, until: Callable[[], bool], pause: float = 1.0, longest: float = 60.0) -> None:
        """Keep the started pipelines running until `until` says so.

        A pipeline that has failed, or could not start, is recorded and started again from its
        checkpoint, which replays the failed batch. The pause before a restart doubles with
        each failure in a row, up to `longest`; a finished batch ends the row. A pipeline that
        was stopped on purpose stays stopped.
        """
        row = {name: 0 for name in (*self.queries, *self.failures)}
        due = dict.fromkeys(row, 0.0)
        seen = dict.fromkeys(row, -1)
        while not until():
            for name in row:
                query = self.queries.get(name)
                if query is not None and query.isActive:
                    report = query.lastProgress
                    if report and report["batchId"] > seen[name]:
                        seen[name], row[name] = report["batchId"], 0
                    continue
                error = query.exception() if query is not None else None
                if query is not None and error is None:
                    continue
                if error is not None and due[name] == 0.0:
                    self.failures[name] = str(error)
                    due[name] = time.monotonic() + min(longest, pause * 2 ** row[name])
                    row[name] += 1
                if time.monotonic() < due[name]:
                    continue
                try:
                    self.queries[name] = self._start(name, continuous=True)
                    self.restarts[name] = self.restarts.get(name, 0) + 1
                    due[name] = 0.0
                except Exception as failure:  # noqa: BLE001 - recorded, tried again
                    self.failures[name] = str(failure)
                    due[name] = time.monotonic() + min(longest, pause * 2 ** row[name])
                    row[name] += 1
            time.sleep(min(pause, 0.2))

    def run_available(self, attempts: int = ATTEMPTS) -> None:
        """Take in what has landed. A failed pipeline restarts from its checkpoint, which
        replays the failed batch; what it has already written is replaced. The daily views
        follow when the tables they read are done."""
        for names in (LANDINGS, VIEWS):
            self.start(continuous=False, names=names)
            for name in names:
                if name in self.queries:
                    self._finish(name, attempts)

    def _finish(self, name: str, attempts: int) -> None:
        for attempt in range(1, attempts + 1):
            try:
                self.queries[name].awaitTermination()
                self.failures.pop(name, None)
                break
            except StreamingQueryException as error:
                self.failures[name] = str(error)
                if attempt < attempts:
                    time.sleep(PAUSE_SECONDS)
                    self.queries[name] = self._start(name, continuous=False)

    def record(self) -> ProgressLog:
        """From now on keep a log of what the pipelines do; `stop` ends it."""
        self.log = ProgressLog(self.spark, self.warehouse)
        self.spark.streams.addListener(self.log)
        return self.log

    def compact(self) -> dict[str, int | None]:
        """Snapshot the keyed and the daily tables; may run beside the pipelines. Gives the
        newest batch each keyed table's snapshot covers."""
        compact_daily(self.warehouse, self.spark)
        return compact(self.warehouse, self.spark)

    def maintain(self) -> dict[str, int | None]:
        """Snapshots, merged batches, and removal of what both replace; run it now and then,
        say once a day, beside the pipelines. Gives the newest batch merged of each table."""
        for name in (*self.compact(), *DAILY_TABLES, KEY_ENDS.name):
            self.warehouse.drop_old_snapshots(self.spark, name)
        return merge_batches(self.warehouse, self.spark, followed=self.settings.rollups.enabled)

    def stop(self) -> None:
        for query in self.queries.values():
            query.stop()
        if self.log:
            self.spark.streams.removeListener(self.log)
            self.log = None
