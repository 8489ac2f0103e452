"""Merged batches: the same rows from a bounded number of files, whatever ran before."""

import pytest
from samples import ALERT, COUNT, LATENCY, alerts, created, package, write_packages

from skyledger.config import default_settings
from skyledger.schemas import KEYPOOL_TABLES, STATION_TABLES
from skyledger.streaming import ingest, progress, rollups
from skyledger.streaming.newest import newest_rows
from skyledger.streaming.service import IngestService
from skyledger.streaming.warehouse import BATCH, Warehouse


@pytest.fixture()
def deployment(tmp_path):
    settings = default_settings(str(tmp_path), rollups=True)
    for name in ("logs", "packages"):
        (tmp_path / "landing" / name).mkdir(parents=True)
    return settings, tmp_path / "landing"


def land(landing, number):
    write_packages(landing / "packages", [package(number, alerts=alerts({**ALERT, "alert_id": f"a-{number}"}))], start=number)
    part = landing / "logs" / f".{number}.part"
    part.write_text("\n".join([created(sequence=number), created(identity=f"{number:036d}"), LATENCY, COUNT, "x"]) + "\n")
    part.rename(landing / "logs" / f"keypool_{number}.log")


def run(spark, settings):
    running = IngestService(spark, settings)
    running.run_available()
    assert running.failures == {}
    return running


def everything(spark, warehouse):
    tables = {n: ingest.keypool_table(warehouse, spark, n) for n in [*KEYPOOL_TABLES, "processed_files"]}
    tables |= {n: ingest.station_table(warehouse, spark, n) for n in STATION_TABLES if n != "ogs_processed_packages"}
    tables |= {n: rollups.daily_table(warehouse, spark, n) for n in rollups.DAILY_TABLES}
    tables |= {
        "packages": ingest.package_ledger(warehouse, spark),
        "counters": progress.ingest_counters(warehouse, spark),
        "entered": ingest.entered_alerts(warehouse, spark),
        "newest": newest_rows(warehouse, spark, "ogs_link_data"),
    }
    return {n: sorted(str(sorted(r.asDict().items())) for r in frame.collect()) for n, frame in tables.items()}


def test_merged_batches_hold_the_same_rows(spark, deployment, tmp_path):
    settings, landing = deployment
    plain = default_settings(str(tmp_path / "plain"), rollups=True)
    (tmp_path / "plain").mkdir()
    (tmp_path / "plain" / "landing").symlink_to(landing)
    for number in range(3):
        land(landing, number)
        running = run(spark, settings)
        if number:
            running.maintain()
        run(spark, plain)
    other = Warehouse(plain.warehouse)
    told, wanted = everything(spark, running.warehouse), everything(spark, other)
    assert {n for n in wanted if told[n] != wanted[n]} == set()
    assert all(rows for name, rows in wanted.items() if name != "controller_syncs")
    # Batches that an earlier merge stands for are gone, but for those another stream reads.
    folders = lambda table: sorted(p.name for p in (tmp_path / "tables" / table).glob(f"{BATCH}=*"))
    assert folders("ogs_link_data") == ["batch=1", "batch=2"]
    assert {"batch=0", "batch=1", "batch=2"} <= set(folders(ingest.ENTRIES))


def test_files_stay_few(spark, tmp_path):
    warehouse = Warehouse(str(tmp_path))
    total = 0
    for batch in range(12):
        rows = spark.range(10).selectExpr("id", f"id + {batch} AS v", "CAST(id % 2 AS STRING) AS cut").repartition(5)
        warehouse.write(rows, "t", batch, "cut")
        total += 10
        if batch % 3 == 2:
            warehouse.merge(spark, "t", "cut")
            assert warehouse.read(spark, "t").count() == total
            # A second call right away has nothing to add.
            warehouse.merge(spark, "t", "cut")
    read = warehouse.read(spark, "t")
    assert read.count() == 120 and read.where("batch = 5").count() == 10
    assert sorted(p.name for p in (tmp_path / "t").glob("batch=*")) == ["batch=11"]
    assert len(list((tmp_path / "_merged" / "t").rglob("*.parquet"))) <= 4 * 2
    plan = read.where("cut = '1'")._jdf.queryExecution().executedPlan().toString()
    filters = [line.split("PartitionFilters: ")[1].split("PushedFilters")[0] for line in plan.split("\n") if "FileScan" in line]
    assert len(filters) == 2 and all("cut" in f for f in filters)


def test_a_segment_without_manifest_is_not_there(spark, tmp_path):
    warehouse = Warehouse(str(tmp_path))
    for batch in range(3):
        warehouse.write(spark.range(5), "t", batch)
    spark.range(7).selectExpr("id", "0 AS batch").write.parquet(f"{tmp_path}/_merged/t/segment=cut-short")
    assert warehouse.read(spark, "t").count() == 15
    assert warehouse.merge(spark, "t") == 1 and warehouse.read(spark, "t").count() == 15
    assert warehouse.merge(spark, "none") is None
