"""Dumps while batches are written: one batch everywhere."""

import pytest
from samples import ALERT, LATENCY, alerts, created, package, write_packages

from skyledger.config import default_settings
from skyledger.plans import export
from skyledger.streaming import dumps, ingest, service
from skyledger.streaming.service import IngestService


@pytest.fixture()
def deployment(tmp_path):
    settings = default_settings(str(tmp_path))
    for name in ("logs", "packages"):
        (tmp_path / "landing" / name).mkdir(parents=True)
    return settings, tmp_path / "landing"


def land(landing, number):
    item = alerts({**ALERT, "alert_id": f"a-{number}", "related_pass_id": None})
    write_packages(landing / "packages", [package(number, alerts=item)], start=number)
    part = landing / "logs" / f".{number}.part"
    part.write_text(f"{created(sequence=number)}\n{LATENCY}\n")
    part.rename(landing / "logs" / f"keypool_{number}.log")


def run(spark, settings, attempts=3):
    running = IngestService(spark, settings)
    running.run_available(attempts)
    return running


def test_a_dump_between_two_batches_restores_to_one(spark, deployment, tmp_path, monkeypatch):
    settings, landing = deployment
    warehouse = run(spark, settings).warehouse
    assert dumps.dump_all(warehouse, spark, str(tmp_path / "none")) == {}
    land(landing, 1)
    assert run(spark, settings).failures == {}
    first = str(tmp_path / "first")
    assert dumps.dump_all(warehouse, spark, first) == {"keypool": 0, "station": 0}
    # The next batch of the station fails behind all its tables but the last.
    land(landing, 2)
    monkeypatch.setattr(service, "PAUSE_SECONDS", 0)
    with monkeypatch.context() as broken:
        broken.setattr(ingest.station, "package_ledger", lambda _: (_ for _ in ()).throw(RuntimeError("lost")))
        assert set(run(spark, settings, 1).failures) == {"station"}
    assert ingest.station_table(warehouse, spark, "ogs_environment_data").count() == 2
    between = str(tmp_path / "between")
    assert dumps.dump_all(warehouse, spark, between) == {"keypool": 1, "station": 0}
    assert dumps.dumped_batches(spark, between) == {"keypool": 1, "station": 0}
    rows = lambda path, name: sorted(map(str, export.restore(spark, path, name).collect()))
    for name in dict.fromkeys([*dumps.STATION_NAMES, "ogs_processed_packages"]):
        assert rows(between, name) == rows(first, name)
    assert len(rows(first, "sync_latency_metrics")) == 1 and len(rows(between, "sync_latency_metrics")) == 2
    assert export.restore(spark, between, "key_creations").first().sequence_number == 2
    # Replayed, the batch is whole, and in the next dump.
    assert run(spark, settings).failures == {}
    last = str(tmp_path / "last")
    assert dumps.dump_all(warehouse, spark, last) == {"keypool": 1, "station": 1}
    assert {n: len(rows(last, n)) for n in ("ogs_environment_data", "ogs_alerts", "ogs_processed_packages")} == {
        "ogs_environment_data": 2, "ogs_alerts": 2, "ogs_processed_packages": 2,
    }
