"""What streams land and store in files that grow in number, not in size."""

import gzip
import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from skyledger.bindings import queries, stand_ins
from skyledger.streaming import ingest

KINDS = ("purchase", "view", "click", "signup", "error")


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("tables")
    number = F.col("id")
    spark.range(600).select(
        number.alias("event_id"),
        F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, id * 3600 / 10)").alias("ts"),
        (number % 15).alias("user_id"),
        F.element_at(F.array(*map(F.lit, KINDS)), (number % 5 + 1).cast("int")).alias("event_type"),
        (number % 97 * 1.25).alias("value"),
    ).write.parquet(f"{path}/events.parquet")
    return str(path)


def landed(folder):
    """The lines of each landed file, in the order of the files' names."""
    return [gzip.open(file, "rt").read().splitlines() for file in sorted(Path(folder).glob("part-*"))]


def test_landed_files_are_small_compressed_and_in_order(spark, sf_dir, tmp_path, monkeypatch):
    monkeypatch.setattr(stand_ins, "DOCUMENTS_PER_FILE", 20)
    found = []
    for third in range(3):
        folder = str(tmp_path / f"third-{third}")
        stand_ins.land_documents(spark, sf_dir, folder, third)
        files = landed(folder)
        assert len(files) == 10 and max(map(len, files)) <= 60
        packages = [{json.loads(line)["package_timestamp"] for line in lines} for lines in files]
        assert sum(map(len, packages)) == len(set().union(*packages)) == 100
        found += [line for lines in files for line in lines]
    documents = stand_ins.package_documents(spark, sf_dir).orderBy("ord").select("document").collect()
    assert found == [row[0] for row in documents]


def test_deliveries_are_stored_in_files_a_task_can_sort(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(ingest, "DELIVERIES_PER_FILE", 7)
    monkeypatch.setattr(queries, "_RUNS", {})
    split = spark.conf.get("spark.sql.files.maxPartitionBytes")
    warehouse = queries._package_stream(spark, sf_dir)
    stored = spark.read.parquet(warehouse.folder("package_deliveries"))
    per_file = stored.groupBy(F.col("_metadata.file_path")).count()
    assert per_file.agg(F.max("count"), F.sum("count")).first() == (7, 600)
    # The split is set for the stream alone.
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == split


def test_repeated_deliveries_land_compressed(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(queries, "_RUNS", {})
    taken = queries.stream_package_dedup(spark, sf_dir).count()
    (warehouse,) = queries._RUNS.values()
    landing = Path(warehouse.root.removeprefix("file:")) / "landing"
    assert taken and list(landing.glob("part-*")) and all(f.suffix == ".gz" for f in landing.glob("part-*"))
