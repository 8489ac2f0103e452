"""Newest-N states: what a refreshing panel reads instead of a table's history.

A state is the newest rows of a table, at most so many. States merge: the newest rows of two
are the newest of their union. Each micro-batch merges its own rows into the state before it
and writes the result, one small file, into one of a few slots that take turns. So a state is
never changed in place, a replayed batch writes its own slot again, and neither reading nor
writing looks at more than a few files, however long the pipeline has run.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.operators.station import BUFFERED_ALERTS
from skyledger.plans.panels import SHOWN_ALERTS
from skyledger.plans.views import LATEST_READINGS
from skyledger.streaming.warehouse import BATCH, Warehouse

SLOT = "slot"
# A reader may still have the file of the state before open when the next batch writes.
SLOTS = 4


@dataclass(frozen=True)
class Newest:
    """The newest `size` rows of a table by `moment`, ties by arrival."""

    table: str
    size: int
    moment: str = "timestamp"

    def of(self, rows: DataFrame) -> DataFrame:
        return rows.orderBy(F.desc(self.moment), F.desc("ord")).limit(self.size)

    @property
    def folder(self) -> str:
        return f"_newest/{self.table}"


# As many rows as the largest view of a table shows.
STATES = {
    state.table: state
    for state in (
        Newest("ogs_environment_data", LATEST_READINGS),
        Newest("ogs_link_data", LATEST_READINGS),
        Newest("ogs_alerts", max(SHOWN_ALERTS, BUFFERED_ALERTS)),
    )
}


def _slots(warehouse: Warehouse, spark: SparkSession, state: Newest) -> DataFrame | None:
    try:
        return spark.read.parquet(warehouse.folder(state.folder))
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def _last(slots: DataFrame) -> DataFrame:
    """The state of the newest batch among some slots."""
    return slots.where(F.col(BATCH) == slots.agg(F.max(BATCH)).scalar()).drop(BATCH, SLOT)


def merge_newest(warehouse: Warehouse, rows: DataFrame, table: str, batch_id: int) -> None:
    """Write the state after a batch: of the state before it and the batch's own rows."""
    state = STATES[table]
    merged = state.of(rows)
    slots = _slots(warehouse, rows.sparkSession, state)
    own = batch_id % SLOTS
    if slots is not None:
        # The own slot holds a state long replaced, or the one a failed run of this batch wrote.
        before = _last(slots.where((F.col(SLOT) != own) & (F.col(BATCH) < batch_id)))
        merged = state.of(before.unionByName(merged))
    path = f"{warehouse.folder(state.folder)}/{SLOT}={own}"
    merged.withColumn(BATCH, F.lit(batch_id).cast("long")).coalesce(1).write.mode("overwrite").parquet(path)


def newest_rows(warehouse: Warehouse, spark: SparkSession, table: str) -> DataFrame | None:
    """The newest rows of a table with their order; None before the first batch.

    The views and panels of the newest rows take these in place of the table.
    """
    slots = _slots(warehouse, spark, STATES[table])
    return None if slots is None else _last(slots)
