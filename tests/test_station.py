import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F
from samples import ALERT, ENVIRONMENT, LINK, PLANNED, SUMMARY, alerts, documents, package

from skyledger.functions.times import package_time, package_time_text
from skyledger.operators import assemble, quality, station
from skyledger.schemas import STATION_TABLES
from skyledger.sources.packages import parse_documents


def parsed(spark, *packages):
    return parse_documents(documents(spark, packages))


def settled(spark, *packages):
    return station.settle(parsed(spark, *packages))


def summary(**changes):
    result = json.loads(json.dumps(SUMMARY))
    for name in ("lock_percentage",):
        if name in changes:
            result["link_lock"][name] = changes.pop(name)
    if "keys_distilled" in changes:
        result["key_distillation"]["keys_distilled"] = changes.pop("keys_distilled")
    return result | changes


@pytest.mark.parametrize(
    "text, stored",
    [
        ("2025-11-19T10:49:48Z", "2025-11-19 10:49:48"),
        ("2025-11-19T10:49:48.123456Z", "2025-11-19 10:49:48"),
        ("2025-11-19 10:49:48.999", "2025-11-19 10:49:48"),
        ("", None),
        (None, None),
    ],
)
def test_package_time(spark, text, stored):
    row = spark.createDataFrame([(text,)], "t string").select(
        package_time_text(F.col("t")).alias("s"), package_time(F.col("t")).alias("m")
    ).first()
    assert row.s == stored
    assert row.m == (dt.datetime.fromisoformat(stored) if stored else None)


def test_unreadable_package_time_is_null(spark):
    assert spark.range(1).select(package_time(F.lit("soon"))).first()[0] is None


def test_environment(spark):
    row = station.environment_rows(settled(spark, package(0))).drop("ord").first()
    assert row.asDict() == {
        "timestamp": dt.datetime(2025, 11, 19, 10, 49, 48), "ogs_id": "OGS-001", "dome_open": True,
        "dome_anomaly": False, "temperature": 20.25, "wind_speed": 3.5, "wind_direction": 120, "humidity": 45.5,
        "air_pressure": 1012.0, "cloud_cover": -5, "precipitation": False, "brightness": 25000,
    }


def test_link(spark):
    row = station.link_rows(settled(spark, package(0))).drop("ord").first()
    assert row.asDict() == {
        "timestamp": dt.datetime(2025, 11, 19, 10, 49, 48), "pass_id": "pass-1", "quantum_locked": True,
        "tracking_status": "LOCKED", "qber": 0.0151, "link_power_margin": 3.1, "received_power": -43.5,
        "uplink_power": -42.0, "fso_uplink_power": -10.5, "fso_downlink_power": -11.2, "fso_status": "active",
    }


def test_missing_keys_are_null_and_unknown_keys_ignored(spark):
    odd = {"timestamp": "2025-11-19T10:49:48Z", "ogs_id": "o", "weather": {"temperature_c": 1.5, "new": 3}, "dome_status": None}
    row = station.environment_rows(settled(spark, package(0, environment=odd))).first()
    assert (row.temperature, row.wind_speed, row.dome_open) == (1.5, None, None)


def test_pass_summary_upsert(spark):
    packages = [
        package(0, summary=summary()),
        package(1, summary=summary(end_time="2025-11-19T10:50:00Z", lock_percentage=90.0, keys_distilled=120, notes="second")),
        package(2, summary=summary(end_time="2025-11-19T10:51:00Z", lock_percentage=None, keys_distilled=125, notes="third")),
        package(3, summary=summary(pass_id="pass-2")),
    ]
    rows = station.pass_summary(station.summary_rows(settled(spark, *packages))).collect()
    row = {r.pass_id: r for r in rows}["pass-1"]
    assert len(rows) == 2 and rows[0].asDict().keys() == set(STATION_TABLES["ogs_pass_summary"])
    assert (row.end_time, row.lock_percentage, row.keys_distilled) == (dt.datetime(2025, 11, 19, 10, 51), None, 125)
    assert (row.notes, row.start_time) == ("first", dt.datetime(2025, 11, 19, 10, 34, 48))


def alert(alert_id, related="pass-1", **changes):
    return ALERT | {"alert_id": alert_id, "related_pass_id": related} | changes


def stored_alerts(spark, *packages):
    s = settled(spark, *packages)
    passes = station.first_seen_passes(station.summary_rows(s))
    return sorted(
        [(r.alert_id, r.description) for r in station.alerts(station.alert_rows(s), passes).collect()], key=repr
    )


def test_alerts_keep_the_first_of_an_id_and_all_without_one(spark):
    packages = [
        package(0, alerts=alerts(alert("a", description="first"), alert("a", description="same list"))),
        package(1, alerts=alerts(alert("a", description="later"), alert(None, description="n1"))),
        package(2, alerts=alerts(alert(None, description="n2"))),
    ]
    assert stored_alerts(spark, *packages) == sorted([("a", "first"), (None, "n1"), (None, "n2")], key=repr)


def test_alert_needs_its_pass_at_that_moment(spark):
    packages = [
        package(0, alerts=alerts(alert("late", "pass-2", description="early"), alert("lost", "nowhere"))),
        package(1, alerts=alerts(alert("free", None), alert("same", "pass-1"))),
        package(2, summary=summary(pass_id="pass-2"), alerts=alerts(alert("late", "pass-2", description="retried"))),
    ]
    assert stored_alerts(spark, *packages) == [("free", "d"), ("late", "retried"), ("same", "d")]


def test_alert_without_time_is_rejected(spark):
    s = settled(spark, package(0, alerts=alerts(alert("a", timestamp=None), alert("b"))))
    passes = station.first_seen_passes(station.summary_rows(s))
    assert [r.alert_id for r in station.alerts(station.alert_rows(s), passes).collect()] == ["b"]
    assert [(r.table, r.missing) for r in quality.rejected_items(s).collect()] == [("ogs_alerts", ["timestamp"])]


def test_schedule_upsert(spark):
    def plan(time, *passes):
        return {"generated_at": time, "ogs_id": "OGS-001", "scheduled_passes": list(passes)}

    packages = [
        package(0, schedule=plan("2025-11-19T10:00:00Z", PLANNED, PLANNED | {"pass_id": None})),
        package(1, schedule=plan("2025-11-19T10:05:00Z", PLANNED | {"estimated_keys": 99, "satellite_id": "SAT-7"})),
    ]
    s = settled(spark, *packages)
    (row,) = station.pass_schedule(station.schedule_rows(s)).collect()
    assert (row.estimated_keys, row.satellite_id) == (99, "SAT-1")
    assert (row.generated_at, row.max_elevation) == (dt.datetime(2025, 11, 19, 10, 5), 70.0)
    assert quality.rejected_items(s).count() == 1


STATUS = ["environment_ok", "link_ok", "summary_ok", "alerts_ok", "package_ok"]


@pytest.mark.parametrize(
    "sections, flags",
    [
        ({}, (True, True, True, True, True)),
        ({"environment": None}, (False, True, True, True, False)),
        ({"environment": {}}, (False, True, True, True, False)),
        ({"environment": ENVIRONMENT | {"ogs_id": None}}, (False, True, True, True, False)),
        ({"link": {}}, (True, False, True, True, False)),
        ({"link": LINK | {"timestamp": "soon"}}, (True, False, True, True, False)),
        ({"summary": SUMMARY | {"pass_id": None}}, (True, True, False, True, False)),
        ({"alerts": None}, (True, True, True, False, False)),
        ({"alerts": {}}, (True, True, True, True, True)),
        ({"alerts": alerts(ALERT)}, (True, True, True, True, True)),
        ({"schedule": None}, (True, True, True, True, True)),
    ],
)
def test_package_status(spark, sections, flags):
    row = station.package_status(parsed(spark, package(0, **sections))).first()
    assert tuple(row[c] for c in STATUS) == flags


def test_broken_document(spark):
    packages = parsed(spark, "{ not json", package(1))
    rows = station.package_status(packages).orderBy("ord").collect()
    assert [r.package_ok for r in rows] == [False, True]
    counted = station.ingest_counters(packages).first()
    assert (counted.total_processed, counted.failed) == (1, 1)
    assert counted.last_process == dt.datetime(2025, 11, 19, 10, 0, 1)
    reasons = {(r.section, r.reason) for r in quality.rejected_sections(packages).where("ord = 0").collect()}
    assert reasons == {(s, "missing_section") for s in ("environment", "link", "summary", "alerts", "schedule")}


def test_repeated_delivery_is_stored_once(spark):
    warm = ENVIRONMENT | {"weather": {"temperature_c": 30.0}}
    packages = [package(0, link=None), package(0, environment=warm), package(0), package(1)]
    s = settled(spark, *packages)
    rows = {r.package_timestamp[17:19]: r for r in s.collect()}
    first = rows["00"]
    assert len(rows) == 2 and first.deliveries == 3
    # The environment is the first delivery's, the link comes from the delivery that has one.
    assert (first.environment_ord, first.link_ord, first.summary_ord) == (0, 1, 0)
    assert station.environment_rows(s).count() == 2 and station.link_rows(s).count() == 2
    assert station.environment_rows(s).where("temperature = 30").count() == 0
    counted = station.ingest_counters(parsed(spark, *packages)).first()
    assert (counted.total_processed, counted.failed) == (2, 0)


def test_deliveries_without_a_name_are_all_kept(spark):
    nameless = package(0) | {"package_timestamp": None}
    s = settled(spark, nameless, nameless)
    assert s.count() == 2 and station.environment_rows(s).count() == 2
    assert station.package_ledger(s).count() == 0


def test_package_ledger(spark):
    s = settled(
        spark,
        package(0, alerts=alerts(alert("a"), alert("b"), alert("c", timestamp=None))),
        package(1, environment=None),
    )
    rows = {r.package_timestamp[17:19]: r for r in station.package_ledger(s).collect()}
    assert (rows["00"].records_inserted, rows["01"].records_inserted) == (5, 2)
    assert rows["00"].environment_done and not rows["01"].environment_done


def test_result_does_not_depend_on_row_order(spark):
    packages = [
        package(i % 7, summary=summary(pass_id=f"pass-{i % 3}", notes=str(i)), alerts=alerts(alert(f"a{i % 4}", f"pass-{i % 5}")))
        for i in range(20)
    ]
    docs = documents(spark, packages).collect()
    results = []
    for seed in (1, 2):
        rows = random.Random(seed).sample(docs, len(docs))
        s = station.settle(parse_documents(spark.createDataFrame(rows, "file_name string, ord long, document string")))
        summaries = station.summary_rows(s)
        stored = station.alerts(station.alert_rows(s), station.first_seen_passes(summaries))
        results.append((sorted(station.pass_summary(summaries).collect()), sorted(stored.collect())))
    assert results[0] == results[1]


def test_collector_rows(spark):
    row = station.collector_rows(parsed(spark, package(4))).first()
    assert (row.collector_id, row.collector_status, row.last_fetch, row.total_fetches) == (
        "log_collector_001", "operational", None, 4,
    )


def test_assembled_sections_flatten_to_the_same_rows(spark):
    source = settled(spark, *[package(i, alerts=alerts(alert("a"))) for i in range(3)])
    for rows, section, mappings, flatten in [
        (station.environment_rows(source), "environment", assemble.ENVIRONMENT_COLUMNS, station.environment_rows),
        (station.link_rows(source), "link", assemble.LINK_COLUMNS, station.link_rows),
        (station.summary_rows(source), "summary", assemble.SUMMARY_COLUMNS, station.summary_rows),
    ]:
        text = F.lit("x")
        document = assemble.package_document(
            F.col("ord").cast("string"), text, text, {section: assemble.nested(mappings)}, text, text, F.lit(1)
        )
        back = parse_documents(rows.select(text.alias("file_name"), "ord", document.alias("document")), [section])
        assert sorted(flatten(station.settle(back)).collect()) == sorted(rows.collect())


def test_snapshot_holds_the_newest_of_everything(spark):
    def numbered(n):
        return alert(f"a{n:02d}", timestamp=f"2025-11-19T10:{n:02d}:00Z")

    s = settled(spark, *[package(i, alerts=alerts(numbered(i))) for i in range(12)])
    summaries = station.summary_rows(s)
    stored = station.alerts(station.alert_rows(s), station.first_seen_passes(summaries), with_order=True)
    stored = stored.withColumnRenamed("first_ord", "ord")
    collector = station.collector_rows(parsed(spark, package(3)))
    row = assemble.snapshot(
        station.environment_rows(s), station.link_rows(s), summaries, stored, station.schedule_rows(s), collector,
        "2025-11-19 12:00:05",
    ).first()
    assert row.file_name == "package_20251119_120005.json"
    document = json.loads(row.document)
    assert document["data"]["alerts"]["count"] == 10
    assert [a["alert_id"] for a in document["data"]["alerts"]["alerts"]] == [f"a{n:02d}" for n in range(11, 1, -1)]
    assert document["data"]["link"]["link_status"]["quantum"]["qber"] == 0.0151
    planned = [p["pass_id"] for p in document["data"]["schedule"]["scheduled_passes"]]
    assert planned == [p["pass_id"] for p in package(0)["data"]["schedule"]["scheduled_passes"] if p["pass_id"]]
    # Nothing newer than the moment is in it.
    earlier = assemble.snapshot(
        station.environment_rows(s), station.link_rows(s), summaries, stored, station.schedule_rows(s), collector,
        "2025-11-19 10:03:30",
    ).first()
    held = json.loads(earlier.document)["data"]
    assert [a["alert_id"] for a in held["alerts"]["alerts"]] == ["a03", "a02", "a01", "a00"]
    assert held["environment"] is None
    assert station.recent_alert_buffer(stored).collect()[0]["count"] == 10


def test_bare_sections_settle_alike(spark):
    """The ledger of emptied sections is that of whole ones, out of a shuffle of small rows."""
    empty = {s: None for s in ("environment", "link", "summary", "alerts", "schedule")}
    texts = [package(0), package(0), package(1, environment={}), package(2, **empty), package(2, alerts=alerts(ALERT))]
    whole = parsed(spark, *texts)
    bare = station.bare_sections(whole)
    flags = station.package_status(whole).orderBy("ord").collect()
    assert station.package_status(bare).orderBy("ord").collect() == flags
    ledger = station.package_ledger(station.settle(whole)).orderBy("package_timestamp").collect()
    assert ledger and station.package_ledger(station.settle(bare)).orderBy("package_timestamp").collect() == ledger
    assert bare.schema["environment"].dataType.names == ["timestamp", "ogs_id"]
    offered = station.offered_alerts(station.bare_sections(whole, "environment", "link", "summary"))
    assert sorted(offered.collect()) == sorted(station.offered_alerts(whole).collect())


def test_snapshot_tables_parse_nothing_again(spark, monkeypatch, tmp_path):
    """Each table of a snapshot is read from what was stored; no plan holds the documents' text."""
    from skyledger.bindings import queries, stand_ins

    packages = parsed(spark, package(0), package(1), package(2))
    monkeypatch.setattr(stand_ins, "packages", lambda *_: packages)
    tables = queries._station_tables(spark, str(tmp_path))
    for name in ("environment", "link", "summary", "alerts", "schedule", "collector"):
        plan = tables(name)._jdf.queryExecution().optimizedPlan().toString()
        assert "from_json" not in plan
        assert tables(name).count() or name == "alerts"
