"""Repeats within a watermark, durable counters, the progress log and the archive of landings."""

import time
from dataclasses import replace

import pytest
from samples import ALERT, LATENCY, alerts, package, write_packages

from skyledger.config import default_settings
from skyledger.operators import station
from skyledger.sources.packages import read_packages, stream_packages
from skyledger.streaming import dedup, ingest, progress, service
from skyledger.streaming.progress import ingest_counters, pipeline_events, state_size
from skyledger.streaming.service import IngestService


@pytest.fixture()
def deployment(tmp_path):
    settings = default_settings(str(tmp_path))
    landing = tmp_path / "landing" / "packages"
    landing.mkdir(parents=True)
    (tmp_path / "landing" / "logs").mkdir(parents=True)
    return settings, landing


def run(spark, settings, failures=()):
    running = IngestService(spark, settings)
    running.run_available()
    assert set(running.failures) == set(failures)
    return running


def timed(minute, **changes):
    return {**package(0, **changes), "package_timestamp": f"2025-11-19T{10 + minute // 60:02d}:{minute % 60:02d}:00.5Z"}


def test_repeats_within_the_watermark_and_beyond(spark, tmp_path):
    landing, out = tmp_path / "landing", str(tmp_path / "out")
    taken, reports = [], []
    landings = [
        [timed(0), timed(1), timed(1), timed(2, link=None), {**timed(3), "package_timestamp": "no time"}],
        [timed(1), timed(5), timed(200)],  # 1 is still known
        [timed(200), timed(1), timed(100), timed(195), timed(400)],  # 1 and 100 are too old, 195 is new
        [timed(399), timed(400)],
    ]
    for number, packages in enumerate(landings):
        write_packages(landing, packages, start=10 * number)
        whole = dedup.complete_deliveries(stream_packages(spark, str(landing), 100)).select("package_timestamp")
        writer = dedup.first_within(whole, "30 minutes").writeStream.option("checkpointLocation", str(tmp_path / "c"))
        stream = writer.trigger(availableNow=True).start(out, format="parquet")
        stream.awaitTermination()
        reports.append(state_size(stream))
        taken.append(sorted(r[0][11:16] for r in spark.read.parquet(out).select("package_timestamp").collect()))
    assert taken[0] == ["10:00", "10:01"]
    assert taken[1] == ["10:00", "10:01", "10:05", "13:20"]
    assert taken[2] == sorted([*taken[1], "13:15", "16:40"])
    assert taken[3] == sorted([*taken[2], "16:39"])
    # What the watermark has passed is forgotten.
    assert reports[-1]["state_rows"] < len(taken[3])


def test_counters_over_restarts_equal_the_batch_ones(spark, deployment, monkeypatch):
    settings, landing = deployment
    broken = {"link": None}
    landings = [
        [package(0), package(1, **broken), package(2, **broken), {**package(9), "package_timestamp": None}],
        [package(1), package(0), package(2, **broken), package(3)],
        [package(2), package(4, **broken)],
    ]
    for number, packages in enumerate(landings):
        write_packages(landing, packages, start=10 * number)
        if number == 1:
            calls, original = [], ingest.station.package_ledger

            def failing(settled):
                calls.append(1)
                if len(calls) == 1:
                    raise RuntimeError("executor lost")
                return original(settled)

            monkeypatch.setattr(ingest.station, "package_ledger", failing)
            monkeypatch.setattr(service, "PAUSE_SECONDS", 0)
        warehouse = run(spark, settings).warehouse
        batch = station.ingest_counters(read_packages(spark, str(landing)))
        assert ingest_counters(warehouse, spark).first().asDict() == batch.first().asDict()
    assert tuple(ingest_counters(warehouse, spark).first())[:2] == (5, 1)


def test_the_log_tells_batches_and_failures(spark, deployment, monkeypatch):
    settings, landing = deployment
    (landing.parent / "logs" / "keypool_1.log").write_text(f"{LATENCY}\n{LATENCY}\n")
    write_packages(landing, [package(0, alerts=alerts(ALERT))])
    monkeypatch.setattr(ingest.station, "settle", lambda _: (_ for _ in ()).throw(RuntimeError("always")))
    running = IngestService(spark, settings)
    running.record()
    running.run_available(attempts=1)
    for _ in range(100):
        events = [r.asDict() for r in pipeline_events(running.warehouse, spark).collect()]
        if {"failed", "ended", "batch"} <= {e["event"] for e in events}:
            break
        time.sleep(0.3)
    running.stop()
    told = {(e["event"], e["name"]) for e in events}
    assert {("started", "keypool"), ("started", "station"), ("ended", "keypool"), ("failed", "station")} <= told
    (batch,) = [e for e in events if e["event"] == "batch" and e["name"] == "keypool"]
    # The batch is read for its lines and for its files.
    assert (batch["batch_id"], batch["input_rows"]) == (0, 4)
    assert "always" in next(e["error"] for e in events if e["event"] == "failed")
    assert running.log is None


def test_done_files_leave_the_landing_folder(spark, deployment, tmp_path):
    settings, landing = deployment
    archive = tmp_path / "archive"
    settings = replace(settings, station=replace(settings.station, archive=str(archive)))
    for number in range(3):
        write_packages(landing, [package(number)], start=number)
        warehouse = run(spark, settings).warehouse
        for _ in range(50):
            if len(list(landing.glob("*.json"))) <= 1:
                break
            time.sleep(0.2)
    # The files of the newest batch stay until the next one is done.
    assert len(list(landing.glob("*.json"))) == 1 and len(list(archive.rglob("*.json"))) == 2
    assert ingest.package_ledger(warehouse, spark).count() == 3
    assert ingest.station_table(warehouse, spark, "ogs_environment_data").count() == 3
    run(spark, settings)
    assert ingest.package_ledger(warehouse, spark).agg({"deliveries": "sum"}).first()[0] == 3


def test_nothing_counted_before_the_first_batch(spark, deployment):
    settings, _ = deployment
    assert ingest_counters(run(spark, settings).warehouse, spark) is None
    assert progress.EVENT.count(",") == 8
