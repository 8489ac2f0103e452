"""Batch-wise tables of the streaming ingest.

Each micro-batch owns one folder `batch=<id>` per table and writes it in overwrite mode,
so a replayed batch replaces its own output and nothing else.

Batches that are whole can be merged: their rows are written again as a segment of few files,
and a manifest, written last, says which batches it stands for. Readers take the segments and
the batches behind them. The folders of merged batches go one merge later, so that nothing is
taken away from a reader that has just listed it.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from skyledger.operators.fold import fold_result, fold_state, merge_states
from skyledger.sources.tables import DAY, write_by_day

BATCH = "batch"
MANIFEST = "covers long, folder string, shape string"
SEGMENT = "segment"


def _remove(spark: SparkSession, folder: str) -> None:
    """Remove a folder from whatever file system it lies in."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def without_batch(rows: DataFrame) -> DataFrame:
    return rows.drop(BATCH, DAY)


@dataclass(frozen=True)
class KeyedTable:
    """A table with one row per key: the stored rows it folds, and how."""

    name: str
    key: str
    replaces: list[str]
    source: str
    prepare: Callable[[DataFrame], DataFrame] = without_batch


@dataclass(frozen=True)
class Warehouse:
    """The folder that holds all tables, and the collation of their string keys."""

    root: str
    collation: str | None = None

    def folder(self, table: str, batch_id: int | None = None) -> str:
        base = f"{self.root}/{table}"
        return base if batch_id is None else f"{base}/{BATCH}={batch_id}"

    def write(
        self, rows: DataFrame, table: str, batch_id: int, *partitions: str, rows_per_file: int = 0
    ) -> DataFrame:
        """Replace one batch of a table, in files of so many rows at most if told; gives the
        written rows back."""
        path = self.folder(table, batch_id)
        writer = rows.write.mode("overwrite").partitionBy(*partitions)
        if rows_per_file:
            writer = writer.option("maxRecordsPerFile", rows_per_file)
        writer.parquet(path)
        return rows.sparkSession.read.schema(rows.schema).parquet(path)

    def write_by_day(self, rows: DataFrame, table: str, batch_id: int, moment: str) -> None:
        write_by_day(rows, self.folder(table, batch_id), moment, mode="overwrite")

    def read(self, spark: SparkSession, table: str) -> DataFrame | None:
        """All batches of a table, None before the first."""
        rows, merged = self._batches(spark, table), self._segments(spark, table)
        if merged is None:
            return rows
        old, covered = merged
        if rows is None:
            return old
        return old.select(*rows.columns).unionByName(rows.where(F.col(BATCH) > covered))

    def _batches(self, spark: SparkSession, table: str) -> DataFrame | None:
        """The batches that have a folder of their own."""
        try:
            return spark.read.parquet(self.folder(table))
        except AnalysisException as error:
            if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                return None
            raise

    # ------------------------------------------------------------ merged batches

    def _published(self, spark: SparkSession, folder: str) -> list:
        """The lines of a table's manifests, oldest first: one per merge or snapshot."""
        try:
            return spark.read.schema(MANIFEST).parquet(folder).orderBy("covers", "folder").collect()
        except AnalysisException as error:
            if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                return []
            raise

    def _segments(self, spark: SparkSession, table: str) -> tuple[DataFrame, int] | None:
        """The rows of all segments of a table, and the newest batch they stand for."""
        lines = self._published(spark, f"{self.root}/_merged_manifests/{table}")
        if not lines:
            return None
        base = f"{self.root}/_merged/{table}"
        shape = StructType.fromJson(json.loads(lines[-1]["shape"]))
        reader = spark.read.schema(shape).option("basePath", base)
        rows = reader.parquet(*[f"{base}/{SEGMENT}={line['folder']}" for line in lines])
        return rows.drop(SEGMENT), lines[-1]["covers"]

    def merge(self, spark: SparkSession, table: str, *partitions: str, remove: bool = True) -> int | None:
        """Write the whole batches behind the last segment as one more segment, cut by
        `partitions`; gives the newest batch the segments stand for, None without any.

        The newest batch may still be written, so it is left out. Unless `remove` is off, as for
        a table that another stream reads batch by batch, the folders of batches that earlier
        merges stand for are removed first.
        """
        lines = self._published(spark, f"{self.root}/_merged_manifests/{table}")
        covered = lines[-1]["covers"] if lines else None
        rows = self._batches(spark, table)
        if rows is None:
            return covered
        held = sorted(row[0] for row in rows.select(BATCH).distinct().collect())
        if covered is not None and remove:
            for batch_id in held:
                if batch_id <= covered:
                    _remove(spark, self.folder(table, batch_id))
        whole = [b for b in held[:-1] if covered is None or b > covered]
        if not whole:
            return covered
        rows = rows.where((F.col(BATCH) >= whole[0]) & (F.col(BATCH) <= whole[-1]))
        folder = f"{whole[-1]:020d}-{uuid.uuid4().hex}"
        merged = rows.hint("rebalance", *partitions) if partitions else rows.hint("rebalance")
        merged.write.partitionBy(*partitions).parquet(f"{self.root}/_merged/{table}/{SEGMENT}={folder}")
        self._publish_line(spark, f"{self.root}/_merged_manifests/{table}", whole[-1], folder, rows.schema)
        return whole[-1]

    # ------------------------------------------------------------ folded tables

    def _snapshot_folder(self, table: str) -> str:
        return f"{self.root}/_snapshots/{table}"

    def _manifest_folder(self, table: str) -> str:
        return f"{self.root}/_manifests/{table}"

    def _latest_snapshot(self, spark: SparkSession, table: str) -> tuple[DataFrame, int] | None:
        """The newest snapshot with a manifest, and the batch it covers.

        What a snapshot covers and how it is shaped stand in its manifest, which is written
        when the snapshot is whole: one without rows counts, one without a manifest does not.
        """
        try:
            manifests = spark.read.schema(MANIFEST).parquet(self._manifest_folder(table))
            newest = manifests.orderBy(F.desc("covers"), F.desc("folder")).first()
        except AnalysisException as error:
            if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                return None
            raise
        if newest is None:
            return None
        shape = StructType.fromJson(json.loads(newest["shape"]))
        path = f"{self._snapshot_folder(table)}/{newest['folder']}"
        return spark.read.schema(shape).parquet(path), newest["covers"]

    def _publish(self, state: DataFrame, table: str, covers: int) -> None:
        """Write a snapshot into a folder of its own, then its manifest."""
        folder = f"covers-{covers}-{uuid.uuid4().hex}"
        state.write.parquet(f"{self._snapshot_folder(table)}/{folder}")
        self._publish_line(state.sparkSession, self._manifest_folder(table), covers, folder, state.schema)

    def _publish_line(self, spark: SparkSession, manifests: str, covers: int, folder: str, shape: StructType) -> None:
        line = spark.range(1).select(
            F.lit(covers).cast("long").alias("covers"),
            F.lit(folder).alias("folder"),
            F.lit(shape.json()).alias("shape"),
        )
        line.coalesce(1).write.mode("append").parquet(manifests)

    def drop_old_snapshots(self, spark: SparkSession, table: str, keep: int = 2) -> None:
        """Remove the snapshots of a table but for the newest ones, which readers may have open."""
        for line in self._published(spark, self._manifest_folder(table))[:-keep]:
            _remove(spark, f"{self._snapshot_folder(table)}/{line['folder']}")

    def state(
        self, spark: SparkSession, table: KeyedTable, upto: int | None = None
    ) -> DataFrame | None:
        """Fold state of a table: its newest snapshot merged with the batches after it, all
        of them or those up to a given one."""
        rows = self.read(spark, table.source)
        if rows is None:
            return None
        if upto is not None:
            rows = rows.where(F.col(BATCH) <= upto)
        snapshot = self._latest_snapshot(spark, table.name)
        if snapshot is None:
            return self._fold(rows, table)
        held, covered = snapshot
        return merge_states(held, self._fold(rows.where(F.col(BATCH) > covered), table))

    def _fold(self, rows: DataFrame, table: KeyedTable) -> DataFrame:
        return fold_state(
            table.prepare(rows), table.key, replaces=table.replaces, collation=self.collation
        )

    def folded(self, spark: SparkSession, table: KeyedTable, with_order: bool = False) -> DataFrame | None:
        """A keyed table: one row per key."""
        state = self.state(spark, table)
        return None if state is None else fold_result(state, with_order)

    def compact(self, spark: SparkSession, table: KeyedTable) -> int | None:
        """Write a snapshot of every finished batch; readers fold only what is newer.

        The newest batch may still be being written, so it is left out: batches run one
        after the other, and one that has a successor is whole. Gives the newest batch
        covered, None when there is nothing to cover.
        """
        rows = self.read(spark, table.source)
        if rows is None:
            return None
        newest = rows.agg(F.max(BATCH)).first()[0]
        finished = rows.where(F.col(BATCH) < newest).agg(F.max(BATCH)).first()[0]
        if finished is None:
            return None
        held = self._latest_snapshot(spark, table.name)
        if held is None or held[1] < finished:
            self._publish(self.state(spark, table, upto=finished), table.name, finished)
        return finished
