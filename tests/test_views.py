import datetime as dt

import pytest
from pyspark.sql import functions as F

from skyledger.functions import display
from skyledger.plans import panels, views
from skyledger.sources.tables import read_table, write_by_day

DAY = dt.datetime(2024, 1, 1)


def readings(spark, count=500, minutes=30):
    """`count` link readings, one every half hour, the last five at one moment."""
    return spark.range(count).select(
        F.col("id").alias("ord"),
        (F.lit("2024-01-01").cast("timestamp_ntz")
         + F.make_dt_interval(mins=F.least(F.col("id"), F.lit(count - 5)) * minutes)).alias("timestamp"),
        F.concat(F.lit("p"), (F.col("id") % 7).cast("string")).alias("pass_id"),
        (F.col("id") % 2 == 0).alias("quantum_locked"),
        F.lit("LOCKED").alias("tracking_status"),
        (F.col("id") / 10000).alias("qber"),
        F.lit(3.0).alias("link_power_margin"),
        F.lit(-43.0).alias("received_power"),
    )


def keys(spark):
    rows = [
        (1, "PUBLIC", 1, 2, DAY), (5, "PUBLIC", 1, 2, DAY + dt.timedelta(hours=3)), (2, "SHARED", 1, 2, DAY),
        (3, "PRIVATE", 1, 2, DAY), (4, "PUBLIC", 1, 2, DAY + dt.timedelta(days=1)), (9, "PUBLIC", 3, 2, DAY),
    ]
    return spark.createDataFrame(
        rows, "sequence_number int, key_pool_type string, source_site_id int, destination_site_id int, timestamp timestamp_ntz"
    )


def test_key_creation_summary(spark):
    rows = views.key_creation_summary(keys(spark)).collect()
    assert len(rows) == 5
    (row,) = [r for r in rows if r.total_keys == 2]
    assert (row.key_pool_type, row.source_site_id, row.date) == ("PUBLIC", 1, DAY.date())
    assert (row.first_key, row.last_key) == (DAY, DAY + dt.timedelta(hours=3))


def test_daily_key_production_order(spark):
    rows = views.daily_key_production(keys(spark)).collect()
    assert [(r.date.day, r.key_pool_type, r.keys_produced) for r in rows] == [
        (2, "PUBLIC", 1), (1, "PUBLIC", 3), (1, "PRIVATE", 1), (1, "SHARED", 1),
    ]
    assert (rows[1].first_sequence, rows[1].last_sequence) == (1, 9)


def test_latency_stats(spark):
    frame = spark.createDataFrame([(1, DAY), (2, DAY), (2, DAY)], "latency_ms int, timestamp timestamp_ntz")
    row = views.latency_stats(frame).first()
    assert (row.avg_latency, row.min_latency, row.max_latency, row.measurement_count) == (1.6667, 1, 2, 3)


def test_latest_takes_the_newest_and_breaks_ties_by_arrival(spark):
    rows = views.newest(readings(spark), 100, "timestamp", ["ord"]).collect()
    assert [r.ord for r in rows] == list(range(499, 399, -1))
    assert len(views.latest_link(readings(spark)).columns) == 7


@pytest.mark.parametrize("count", [1, 3, 60, 100, 400, 500, 900])
def test_day_pruning_changes_nothing(spark, tmp_path, count):
    path = str(tmp_path / "by-day")
    write_by_day(readings(spark), path)
    stored = read_table(spark, path)
    plain = [r.ord for r in views.newest(readings(spark), count, "timestamp", ["ord"]).collect()]
    assert [r.ord for r in views.newest(stored, count, "timestamp", ["ord"]).collect()] == plain
    assert len(plain) == min(count, 500)


def test_latest_of_a_stored_table_reads_the_newest_days_only(spark, tmp_path):
    path = str(tmp_path / "by-day")
    write_by_day(readings(spark), path)
    frame = views.latest_link(read_table(spark, path))
    frame.collect()
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan
    assert "event_date" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "ubquery" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_time_range_is_inclusive_and_prunes_days(spark, tmp_path):
    path = str(tmp_path / "by-day")
    write_by_day(readings(spark), path)
    span = ("2024-01-03 00:00:00", "2024-01-04 12:00:00")
    frame = panels.qber_series(read_table(spark, path), *span)
    rows = frame.collect()
    assert [r.time_sec for r in rows] == sorted(r.time_sec for r in rows)
    assert (str(rows[0].time_sec), str(rows[-1].time_sec)) == span
    assert len(rows) == 73
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(timestamp), GreaterThanOrEqual(timestamp" in plan
    assert "2024-01-03" in plan.split("PartitionFilters: [")[1].split("]")[0] or "19725" in plan
    assert "ReadSchema: struct<ord:bigint,timestamp:timestamp_ntz,qber:double>" in plan


def test_series_columns(spark):
    frame = readings(spark).withColumns({"temperature": F.lit(1.0), "wind_speed": F.lit(2.0)})
    span = ("2024-01-01", "2024-01-02")
    assert panels.temperature_series(frame, *span).first().metric == "Temperature"
    assert panels.wind_series(frame, *span).columns == ["time_sec", "value"]


def test_recent_passes_put_missing_starts_last(spark):
    rows = [(f"p{i}", DAY + dt.timedelta(hours=i) if i else None, i) for i in range(4)]
    frame = spark.createDataFrame(rows, "pass_id string, start_time timestamp_ntz, first_ord int").select(
        "*", *[F.lit(None).cast("string").alias(c) for c in views.RECENT_PASS_COLUMNS if c not in ("pass_id", "start_time")]
    )
    assert [r.pass_id for r in views.recent_passes(frame).collect()] == ["p3", "p2", "p1", "p0"]


def stored_alerts(spark):
    rows = [(i, DAY + dt.timedelta(hours=i), s) for i, s in enumerate(["warning", "critical", "info", None] * 8)]
    return spark.createDataFrame(rows, "ord int, timestamp timestamp_ntz, severity string").select(
        "*", *[F.lit("x").alias(c) for c in ("component", "description", "action_taken")]
    )


def test_active_alerts_are_strictly_newer_than_a_day(spark):
    rows = views.active_alerts(stored_alerts(spark), "2024-01-02 04:00:00").collect()
    assert [r.timestamp.hour + 24 * (r.timestamp.day - 1) for r in rows] == list(range(31, 4, -1))
    assert rows[0].asDict().keys() == set(views.ACTIVE_ALERT_COLUMNS)
    assert views.active_alerts(stored_alerts(spark)).count() == 0


def test_recent_alerts_colours(spark):
    rows = panels.recent_alerts(stored_alerts(spark)).collect()
    assert len(rows) == 10
    assert [r.colour for r in rows[:4]] == [None, None, "red", "yellow"]


@pytest.mark.parametrize(
    "rate, band, gauge",
    [(0.0, "green", 0.0), (0.0199, "green", 0.398), (0.02, "yellow", 0.4), (0.03, "red", 0.6), (0.2, "red", 1.0), (None, None, None)],
)
def test_qber_band(spark, rate, band, gauge):
    row = spark.createDataFrame([(rate,)], "q double").select(
        display.qber_band(F.col("q")).alias("b"), display.qber_gauge(F.col("q")).alias("g")
    ).first()
    assert row.b == band
    assert row.g == (None if gauge is None else pytest.approx(gauge))


def test_latest_qber_keeps_a_newest_null(spark):
    frame = readings(spark).withColumn("qber", F.when(F.col("ord") < 499, F.col("qber")))
    assert panels.latest_qber(frame).first().asDict() == {"qber": None, "band": None, "gauge": None}


def test_dome_status(spark):
    rows = [(0, DAY, False), (1, DAY + dt.timedelta(hours=1), True)]
    frame = spark.createDataFrame(rows, "ord int, timestamp timestamp_ntz, dome_open boolean")
    assert panels.dome_status(frame).first().asDict() == {"dome_open": True, "state": "OPEN", "colour": "green"}
    closed = panels.dome_status(frame.where("ord = 0")).first()
    assert (closed.state, closed.colour) == ("CLOSED", "red")
