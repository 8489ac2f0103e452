"""What pipelines have done: durable counters, and a log of their progress and failures."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from skyledger.functions.times import package_time
from skyledger.operators.station import package_status
from skyledger.streaming.warehouse import Warehouse

COUNTERS = "ingest_counters"
EVENTS = "_events"
EVENT = (
    "event string, name string, run string, batch_id long, moment string, input_rows long, state_rows long, "
    "late_rows long, error string"
)


def batch_counters(deliveries: DataFrame, known: DataFrame | None) -> DataFrame:
    """How a batch changes the counters, as one row.

    A package is done with its first whole delivery, in this batch or an earlier one. It has
    failed while it has none: it counts once when first met, and no more when it is done.
    `known` has package_timestamp and package_done of the packages of earlier batches. A
    delivery without a package time is a package of its own.
    """
    per_package = (
        package_status(deliveries)
        .groupBy("package_timestamp", F.when(F.col("package_timestamp").isNull(), F.col("ord")).alias("_loose"))
        .agg(F.bool_or(F.coalesce("package_ok", F.lit(False))).alias("done"))
    )
    if known is None:
        met = per_package.withColumns({"before": F.lit(False), "seen": F.lit(False)})
    else:
        earlier = known.select("package_timestamp", F.col("package_done").alias("before"), F.lit(True).alias("seen"))
        met = per_package.join(earlier, "package_timestamp", "left")
    no = F.lit(False)
    seen, before = F.coalesce("seen", no), F.coalesce("before", no)
    newly = F.col("done") & ~before
    return met.agg(
        F.count_if(newly).alias("done"),
        (F.count_if(~F.col("done") & ~seen) - F.count_if(newly & seen)).alias("failed"),
        F.max(F.when(F.col("done"), package_time(F.col("package_timestamp")))).alias("last_process"),
    )


def ingest_counters(warehouse: Warehouse, spark: SparkSession) -> DataFrame | None:
    """Packages done and not done so far, and the time of the newest done one; restarts and
    replays do not change them."""
    rows = warehouse.read(spark, COUNTERS)
    if rows is None:
        return None
    return rows.agg(
        F.sum("done").alias("total_processed"), F.sum("failed").alias("failed"), F.max("last_process").alias("last_process")
    )


class ProgressLog(StreamingQueryListener):
    """Writes each start, batch with rows, and end of a pipeline below the tables' root.

    An event is a file of its own, written by a small job off the pipelines' own threads. A
    batch that is replayed is told again; `pipeline_events` gives the last word on each. Rows
    are rows read: a batch that is read twice counts them twice. `ingest_counters` are exact.
    """

    def __init__(self, spark: SparkSession, warehouse: Warehouse):
        self.spark, self.folder = spark, warehouse.folder(EVENTS)

    def _write(self, event: str, name, run, batch=None, moment=None, rows=None, state=None, late=None, error=None) -> None:
        line = [(event, name, str(run), batch, moment, rows, state, late, error)]
        self.spark.createDataFrame(line, EVENT).coalesce(1).write.json(f"{self.folder}/{event}-{uuid.uuid4().hex}")

    def onQueryStarted(self, event) -> None:
        self._write("started", event.name, event.runId, moment=event.timestamp)

    def onQueryProgress(self, event) -> None:
        told = event.progress
        if not told.numInputRows:
            return
        states = told.stateOperators
        self._write(
            "batch", told.name, told.runId, told.batchId, told.timestamp, told.numInputRows,
            sum(s.numRowsTotal for s in states), sum(s.numRowsDroppedByWatermark for s in states),
        )

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._write("failed" if event.exception else "ended", None, event.runId, error=event.exception)


def pipeline_events(warehouse: Warehouse, spark: SparkSession) -> DataFrame:
    """The log: one row per event, a replayed batch once, the name filled in where an end lacks it."""
    rows = spark.read.schema(EVENT).option("recursiveFileLookup", True).json(warehouse.folder(EVENTS))
    names = rows.where("event = 'started'").select("run", F.col("name").alias("started_name")).distinct()
    named = rows.join(names, "run", "left").withColumn("name", F.coalesce("name", "started_name")).drop("started_name")
    batches = named.where("event = 'batch'")
    newest = batches.groupBy("name", "batch_id").agg(F.max_by(F.struct(*batches.columns), "moment").alias("row"))
    return named.where("event <> 'batch'").unionByName(newest.select("row.*"))


def state_size(query) -> dict[str, int]:
    """Rows the state of a query holds after its last batch, and rows dropped as late by it."""
    report = query.lastProgress
    states = json.loads(report.json)["stateOperators"] if report else []
    return {
        "state_rows": sum(s["numRowsTotal"] for s in states),
        "late_rows": sum(s["numRowsDroppedByWatermark"] for s in states),
    }
