"""Newest-N states: merged batch by batch, read without the history."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F
from samples import ALERT, alerts, package, write_packages

from skyledger.config import default_settings
from skyledger.plans import panels, views
from skyledger.streaming import ingest, newest
from skyledger.streaming.newest import Newest, merge_newest, newest_rows
from skyledger.streaming.service import IngestService
from skyledger.streaming.warehouse import Warehouse

TABLE = "ogs_link_data"


@pytest.fixture()
def small(monkeypatch):
    monkeypatch.setitem(newest.STATES, TABLE, Newest(TABLE, 5))


def batch(spark, rows, batch_id):
    frame = spark.createDataFrame(rows, "timestamp timestamp_ntz, qber double, delivery int")
    order = F.struct(F.lit(batch_id).cast("long").alias("arrival"), "delivery")
    return frame.withColumn("ord", order).drop("delivery")


def told(frame):
    return [(str(r.timestamp), r.qber) for r in frame.orderBy(F.desc("timestamp"), F.desc("ord")).collect()]


def test_states_merge_to_the_newest_of_all(spark, tmp_path, small):


    r = random.Random(1)
    warehouse, seen = Warehouse(str(tmp_path)), []
    assert newest_rows(warehouse, spark, TABLE) is None
    for batch_id in range(11):
        moment = lambda: dt.datetime(2024, 1, 1) + dt.timedelta(hours=r.randrange(40))
        rows = [(moment(), r.random(), i) for i in range(0 if batch_id in (0, 4) else r.randrange(8))]
        merge_newest(warehouse, batch(spark, rows, batch_id), TABLE, batch_id)
        if batch_id in (3, 7):
            # A run that failed behind this batch is replayed: the state takes the rows once.
            merge_newest(warehouse, batch(spark, rows, batch_id), TABLE, batch_id)
        seen += [(t, batch_id, i, q) for t, q, i in rows]
        want = [(str(t), q) for t, _, _, q in sorted(seen, reverse=True)[:5]]
        assert told(newest_rows(warehouse, spark, TABLE)) == want
    folder = tmp_path / "_newest" / TABLE
    assert len(list(folder.rglob("*.parquet"))) <= newest.SLOTS


@pytest.fixture()
def deployment(tmp_path):
    settings = default_settings(str(tmp_path))
    landing = tmp_path / "landing" / "packages"
    landing.mkdir(parents=True)
    (tmp_path / "landing" / "logs").mkdir(parents=True)
    return settings, landing


def run(spark, settings):
    running = IngestService(spark, settings)
    running.run_available()
    assert running.failures == {}
    return running.warehouse


def alert(number, day, **changes):
    return {**ALERT, "alert_id": f"a-{number}", "timestamp": f"2024-01-{day:02d}T00:00:00Z", "related_pass_id": None, **changes}


def test_panels_of_the_pipeline_read_states_only(spark, deployment):
    settings, landing = deployment
    for start in (0, 3, 6):
        write_packages(landing, [package(start + i) for i in range(3)], start=start)
        warehouse = run(spark, settings)
    link = newest_rows(warehouse, spark, "ogs_link_data")
    table = ingest.station_table(warehouse, spark, "ogs_link_data")
    for frames in (views.latest_link(link), panels.latest_qber(link)):
        assert frames.count() >= 1
    assert views.latest_link(link).collect() == views.latest_link(table).collect()
    for frame in (views.latest_link(link), panels.latest_qber(link), views.latest_environment(
        newest_rows(warehouse, spark, "ogs_environment_data")
    )):
        files = frame.inputFiles()
        assert 0 < len(files) <= newest.SLOTS and all("/_newest/" in file for file in files)


def test_an_alert_enters_once_and_by_its_first_arrival(spark, deployment):
    settings, landing = deployment
    write_packages(landing, [package(0, alerts=alerts(alert(1, 1), alert(2, 2)))])
    run(spark, settings)
    late = [alert(1, 20, severity="critical"), alert(3, 3), alert(3, 9), alert(None, 4, alert_id=None)]
    write_packages(landing, [package(1, alerts=alerts(*late))], start=1)
    warehouse = run(spark, settings)
    entered = ingest.entered_alerts(warehouse, spark)
    day = lambda frame: sorted(str(r.timestamp)[:10] for r in frame.collect())
    assert day(entered) == ["2024-01-01", "2024-01-02", "2024-01-03", "2024-01-04"]
    assert day(newest_rows(warehouse, spark, "ogs_alerts")) == day(ingest.station_table(warehouse, spark, "ogs_alerts"))
    active = views.active_alerts(entered, "2024-01-03 06:00:00")
    assert day(active) == ["2024-01-03", "2024-01-04"]
    plan = active._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "event_date" in plan.split("PartitionFilters")[1][:200] and "Aggregate" not in plan
