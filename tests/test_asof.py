"""As-of joins against plain Python, and package series against single snapshots."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from skyledger.bindings import queries
from skyledger.operators import assemble
from skyledger.operators.asof import Series, Stream, asof, last_rows

START = dt.datetime(2024, 1, 1, 12)
SERIES = Series("2024-01-01 12:00:00", "2024-01-01 13:00:00", every=10, slice_seconds=600)


def at(seconds):
    return None if seconds is None else START + dt.timedelta(seconds=seconds)


def stream_rows(seed, number, station=lambda r: r.choice("ab")):
    r = random.Random(seed)
    return [(station(r), r.choice([None, *range(-900, 4500, 7)]), i, r.choice([None, "x", "y"])) for i in range(number)]


def newest(rows, station, moment, size=1):
    held = sorted((t, o, v) for s, t, o, v in rows if s == station and t is not None and t <= moment)
    return held[-size:][::-1]


SCHEMA = "station string, time timestamp_ntz, ord int, value string"


def frame(spark, rows):
    return spark.createDataFrame([(s, at(t), o, v) for s, t, o, v in rows], SCHEMA).repartition(3)


@pytest.mark.parametrize("slice_seconds", [60, 600, 100_000])
def test_newest_rows_against_python(spark, slice_seconds):
    series = Series(SERIES.start, SERIES.end, 10, slice_seconds)
    many, few = stream_rows(1, 800), stream_rows(2, 9)
    lone = [("a", t, t, "z") for t in (5, 5, 3599, 9000)] + [("b", -500, 0, None)]
    stations = spark.createDataFrame([("a",), ("b",), ("none",)], "station string")
    whole = F.struct("time", "ord", "value")
    streams = {name: Stream(frame(spark, rows), "time", whole) for name, rows in (("many", many), ("few", few), ("lone", lone))}
    streams["last"] = last_rows(series, frame(spark, many), "time", whole, 4, stations)
    found = asof(series, streams, stations).collect()
    assert len(found) == 3 * 361
    told = lambda row: row and (int((row["time"] - START).total_seconds()), row["ord"], row["value"])
    for r in found:
        moment = int((r.moment - START).total_seconds())
        for name, rows in (("many", many), ("few", few), ("lone", lone)):
            want = newest(rows, r.station, moment) if name != "lone" else newest(rows, r.station, moment)
            assert [told(r[name])] == (want or [None]), (name, r)
        assert [told(x) for x in r["last"] or []] == newest(many, r.station, moment, 4)


def test_series_of_one_station_without_mark(spark):
    rows = frame(spark, stream_rows(3, 50, lambda r: "a")).drop("station")
    found = asof(SERIES, {"v": Stream(rows, "time", F.col("value"))}, spark.range(1).select())
    assert found.columns == ["moment", "v"] and found.count() == 361


def test_documents_equal_single_snapshots(spark):
    sf_dir = "/root/testdata/sf0.001"
    tables = queries._station_tables(spark, sf_dir)
    inputs = [tables(n).cache() for n in ("environment", "link", "summary", "alerts", "schedule", "collector")]
    series = Series("2024-01-03 00:00:00", "2024-01-04 00:00:00", every=6 * 3600, slice_seconds=5 * 3600)
    written = {r.moment: r.document for r in assemble.package_series(*inputs, series).collect()}
    assert len(written) == 5
    for moment, document in written.items():
        assert assemble.snapshot(*inputs, moment).first().document == document
    early = assemble.package_series(*inputs, Series("2020-01-01 00:00:00", "2020-01-01 00:00:00")).first().document
    assert early == assemble.snapshot(*inputs, "2020-01-01 00:00:00").first().document


def test_each_station_has_its_own_documents(spark):
    tables = queries._station_tables(spark, "/root/testdata/sf0.001")
    one = [tables(n).cache() for n in ("environment", "link", "summary", "alerts", "schedule", "collector")]
    mark = lambda rows, name: rows.withColumn("station", F.lit(name))
    late = [mark(rows, "s1").unionByName(mark(rows.limit(3), "s2")) for rows in one]
    series = Series("2024-01-03 00:00:00", "2024-01-03 12:00:00", every=3 * 3600)
    stations = spark.createDataFrame([("s1",), ("s2",)], "station string")
    both = assemble.package_series(*late, series, stations).cache()
    alone = assemble.package_series(*one, series)
    assert both.where("station = 's1'").drop("station").exceptAll(alone).count() == 0
    assert both.where("station = 's2'").count() == 5


def test_a_station_is_cut_into_slices_and_aggregated_before_it_moves(spark):
    rows = frame(spark, stream_rows(5, 100, lambda r: "a"))
    stations = spark.createDataFrame([("a",)], "station string")
    plan = asof(SERIES, {"v": Stream(rows, "time", F.col("value"))}, stations)._jdf.queryExecution().executedPlan().toString()
    windows = [line for line in plan.split("\n") if "hashpartitioning(station" in line]
    assert sum("slice" in line for line in windows) >= 2
    assert "partial_max_by" in plan and "Python" not in plan
