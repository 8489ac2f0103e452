"""Helpers the operators share: tables, stored intermediates, bounded key ranges."""

from __future__ import annotations

import atexit
import json
import os
import shutil
import tempfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import skyledger
from skyledger.session import scratch_folder

RANGE_SAMPLE = 20_000
# Rows handed to Python at once. Texts may be long, so far fewer than Spark's own number.
ROWS_AT_ONCE = 1_000
ROWS_KEY = "spark.sql.execution.arrow.maxRecordsPerBatch"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(rows: DataFrame, purpose: str) -> DataFrame:
    """The rows written once to the shared folder and read back; cuts the lineage."""
    folder = scratch_folder(rows.sparkSession, purpose)
    rows.write.parquet(folder)
    return rows.sparkSession.read.schema(rows.schema).parquet(folder)


def range_bounds(keys: DataFrame, column: str, parts: int) -> list[int]:
    """At most `parts` - 1 ascending bounds that cut a whole-number key into even ranges.

    The bounds come from a sample by hash, so equal tables give equal bounds. It holds about
    RANGE_SAMPLE keys at any table size. Only bounds rest on it: every row falls in a range.
    """
    total = keys.count()
    every = max(1, total // RANGE_SAMPLE)
    sample = (
        keys.where(F.col(column).isNotNull() & (F.pmod(F.xxhash64(column), F.lit(every)) == 0))
        .select(F.col(column).cast("long").alias("k"))
        .distinct()
        .orderBy("k")
    )
    found = [row.k for row in sample.collect()]
    if not found:
        return []
    return sorted({found[len(found) * i // parts] for i in range(1, parts)})


def range_index(column: Column, bounds: list[int]) -> Column:
    """How many bounds a key reaches: 0 to len(bounds); null counts as 0."""
    if not bounds:
        return F.lit(0)
    reached = F.filter(F.from_json(F.lit(json.dumps(bounds)), "array<bigint>"), lambda b: b <= column.cast("long"))
    return F.coalesce(F.size(reached), F.lit(0))


def ship_package(spark: SparkSession) -> None:
    """Give the executors this package, once per session, where it is not installed there.

    Batches for Python are made small, as a thousand long texts fill a worker's memory. The
    archive stays on the driver until it ends; Spark hands it to each executor.
    """
    spark.conf.set(ROWS_KEY, str(min(ROWS_AT_ONCE, int(spark.conf.get(ROWS_KEY)))))
    context = spark.sparkContext
    if getattr(context, "_skyledger_shipped", False):
        return
    package = os.path.dirname(os.path.abspath(skyledger.__file__))
    folder = tempfile.mkdtemp(prefix="skyledger-package-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    shutil.copytree(package, f"{folder}/root/skyledger", ignore=shutil.ignore_patterns("__pycache__"))
    context.addPyFile(shutil.make_archive(f"{folder}/skyledger", "zip", f"{folder}/root"))
    context._skyledger_shipped = True
