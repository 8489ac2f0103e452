"""Daily views kept from changes: against the batch views, with repeats, replays and late files."""

import datetime as dt
import random
from dataclasses import replace

import pandas as pd
import pytest
from pyspark.sql import functions as F
from samples import LATENCY, at, created

from skyledger.config import default_settings
from skyledger.operators.fold import fold_state
from skyledger.operators.rollup import Rollup, roll
from skyledger.plans import views
from skyledger.streaming import ingest, rollups, service
from skyledger.streaming.rollups import daily_table
from skyledger.streaming.service import IngestService

ROLLUP = Rollup("r", ("date", "kind"), "value")
SCHEMA = "date date, kind string, value int, weight int"


def test_groups_after_changes_equal_groups_worked_out_anew(spark):
    r = random.Random(2)
    held, history, before = [], [], None
    for _ in range(6):
        changes = []
        for _ in range(r.randrange(1, 25)):
            if held and r.random() < 0.55:
                # The ends go away most often.
                row = r.choice([min(held, key=lambda x: x[2]), max(held, key=lambda x: x[2]), r.choice(held)])
                held.remove(row)
                changes.append((*row, -1))
            else:
                row = (dt.date(2024, 1, r.randrange(1, 4)), r.choice(["a", "b", None]), r.randrange(30))
                held.append(row)
                changes.append((*row, 1))
        history += changes
        frames = [spark.createDataFrame(rows, SCHEMA) for rows in (changes, history)]
        touched = roll(frames[0], before, frames[1], ROLLUP)
        after = {(x.date, x.kind): tuple(x)[2:] for x in (before.collect() if before is not None else [])}
        after |= {(x.date, x.kind): tuple(x)[2:] for x in touched.collect()}
        want: dict = {}
        for date, kind, value in held:
            want.setdefault((date, kind), []).append(value)
        assert {k: v for k, v in after.items() if v[0]} == {k: (len(v), min(v), max(v)) for k, v in want.items()}
        assert all(v == (0, None, None) for k, v in after.items() if k not in want)
        rows = [(*k, *v) for k, v in after.items()]
        before = spark.createDataFrame(rows, "date date, kind string, rows long, least int, greatest int")


@pytest.fixture()
def deployment(tmp_path):
    settings = default_settings(str(tmp_path), station=False, rollups=True)
    logs = tmp_path / "landing" / "logs"
    logs.mkdir(parents=True)
    return settings, logs


def write_log(folder, name, lines):
    part = folder / f".{name}.part"
    part.write_text("".join(f"{line}\n" for line in lines))
    part.rename(folder / name)


def run(spark, settings):
    running = IngestService(spark, settings)
    running.run_available()
    assert running.failures == {}
    return running.warehouse


def rows(frame):
    return sorted(map(repr, (r.asDict() for r in frame.collect())))


def assert_views_equal(spark, warehouse):
    keys = ingest.keypool_table(warehouse, spark, "key_creations")
    latencies = ingest.keypool_table(warehouse, spark, "sync_latency_metrics")
    daily = lambda name: daily_table(warehouse, spark, name)
    summary = rollups.key_creation_summary(daily(rollups.SUMMARY.name))
    assert rows(summary) == rows(views.key_creation_summary(keys).select(summary.columns))
    production = rollups.daily_key_production(daily(rollups.PRODUCTION.name))
    assert rows(production) == rows(views.daily_key_production(keys))
    assert [r.date for r in production.collect()] == [r.date for r in views.daily_key_production(keys).collect()]
    assert rows(rollups.latency_stats(daily(rollups.LATENCY))) == rows(views.latency_stats(latencies))
    return production


def key(number, sequence, **other):
    return created(identity=f"{number:08x}-0000-4000-8000-000000000000", sequence=sequence, **other)


def test_views_follow_repeated_keys(spark, deployment, monkeypatch):
    settings, logs = deployment
    write_log(logs, "keypool_1.log", [key(1, 10), key(2, 20), key(3, 30), key(1, 11), LATENCY])
    warehouse = run(spark, settings)
    (day,) = assert_views_equal(spark, warehouse).collect()
    assert (day.keys_produced, day.first_sequence, day.last_sequence) == (3, 11, 30)
    # Both ends are taken back: the next ones are found again.
    write_log(logs, "keypool_2.log", [key(1, 25), key(3, 21), key(4, 22, pool="SHARED"), at("2025-11-18T10:00:00.5+0000")])
    warehouse = run(spark, settings)
    first = assert_views_equal(spark, warehouse).collect()
    assert [(d.keys_produced, d.first_sequence, d.last_sequence) for d in first] == [(3, 20, 25), (1, 22, 22)]
    # The pipeline has read what it has read; snapshots change nothing.
    run(spark, settings)
    assert rollups.compact_daily(warehouse, spark)[rollups.PRODUCTION.name] is not None
    assert_views_equal(spark, warehouse)
    # A batch that fails behind its changes is replayed.
    calls, original = [], rollups.roll

    def failing(*arguments):
        calls.append(1)
        if len(calls) == 2:
            raise RuntimeError("executor lost")
        return original(*arguments)

    monkeypatch.setattr(rollups, "roll", failing)
    monkeypatch.setattr(service, "PAUSE_SECONDS", 0)
    write_log(logs, "keypool_3.log", [key(2, 5), key(2, 99), key(5, 50), key(6, 1, pool="PRIVATE"), LATENCY])
    warehouse = run(spark, settings)
    assert len(calls) > 2
    assert_views_equal(spark, warehouse)


def test_arrival_decides_not_the_order_of_reading(spark, deployment):
    """One file at a time, in whatever order their parts are listed."""
    settings, logs = deployment
    settings = replace(settings, rollups=replace(settings.rollups, max_files_per_trigger=1))
    for name in ("keypool_b.log", "keypool_a.log", "keypool_c.log"):
        write_log(logs, name, [key(n, 100 * n + ord(name[8])) for n in range(1, 4)])
    warehouse = run(spark, settings)
    assert_views_equal(spark, warehouse)
    changes = warehouse.read(spark, rollups.CHANGES)
    assert changes.agg(F.sum("weight")).first()[0] == 3


def test_keys_are_combined_before_the_shuffle(spark):
    """A key with most rows gives two rows a batch of rows, whatever it had."""
    ends, _ = rollups._state_functions()
    frame = pd.DataFrame({rollups.KEY: ["k"] * 1000 + ["l"], "place": [f"{i:05d}" for i in range(1001)], "sequence_number": range(1001)})
    (left,) = ends(iter([frame.sample(frac=1, random_state=1)]))
    assert sorted(left["place"]) == ["00000", "00999", "01000"]


ROW_OF_KEY = ("PUBLIC", 1, 2, "2024-01-01 00:00:00")


def fold_of_keys(spark, *rows):
    """Fold state of rows of keys: key, place and number; the pool type tells which line it was."""
    full = [(k, place, f"of {place}", *ROW_OF_KEY[1:], number) for k, place, number in rows]
    frame = spark.createDataFrame(full, f"{rollups.KEY} string, ord string, {rollups.ROW_TYPES}")
    return fold_state(frame, rollups.KEY, replaces=rollups.KEY_ENDS.replaces)


def test_changes_of_a_batch_are_worked_out_without_python(spark):
    """No function is called per key, and keys that the batch does not name give no change."""
    before = fold_of_keys(spark, ("same", "1", 7), ("more", "2", 7), ("late", "5", 7), ("mid", "2", 7), ("mid", "6", 8), ("left", "1", 7))
    now = fold_of_keys(spark, ("same", "3", 7), ("more", "3", 9), ("late", "4", 9), ("mid", "4", 9), ("new", "4", 1), ("new", "5", 2))
    changes = rollups.key_changes(now, before)
    told = sorted((r.key_pool_type, r.sequence_number, r.weight) for r in changes.collect())
    assert told == [
        ("of 2", 7, -1), ("of 2", 9, 1),  # a new number
        ("of 4", 2, 1),  # a new key
        ("of 4", 7, 1), ("of 5", 7, -1),  # an earlier line comes late: its row, the newest number
    ]
    plan = changes._jdf.queryExecution().executedPlan().toString()
    assert "Pandas" not in plan and "Python" not in plan
    assert rollups.key_changes(now, None).agg(F.sum("weight"), F.min("weight")).first()[:] == (5, 1)


def test_no_state_is_kept_per_key_of_the_stream(spark, deployment):
    """What a key costs is a row of a table, read again by the batches that name it."""
    settings, logs = deployment
    for number in range(2):
        write_log(logs, f"keypool_{number}.log", [key(n, 10 * n + number) for n in range(number, 40 + number)])
        running = IngestService(spark, settings)
        running.run_available()
        assert running.failures == {}
        assert running.queries["rollups"].lastProgress["stateOperators"] == []
        running.maintain()
    warehouse = running.warehouse
    assert_views_equal(spark, warehouse)
    held = warehouse.folded(spark, rollups.KEY_ENDS)
    assert held.count() == 41 and held.agg(F.max("sequence_number")).first()[0] == 401


def test_without_entries_there_is_nothing_to_roll(spark, deployment):
    settings, _ = deployment
    warehouse = run(spark, settings)
    assert daily_table(warehouse, spark, rollups.SUMMARY.name) is None
    assert ingest.keypool_table(warehouse, spark, "key_creations") is None
