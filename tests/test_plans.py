"""Plans as they should hold on large tables."""

import pytest
from pyspark.sql import functions as F
from samples import LATENCY, created

import __spark_entry__ as entry_points
from skyledger.operators import keypool, station
from skyledger.sources.tables import write_by_day

SF_DIR = "/root/testdata/sf0.001"


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def settings_of(spark):
    changed = []

    def change(**values):
        for name, value in values.items():
            key = name.replace("__", ".")
            changed.append((key, spark.conf.get(key, None)))
            spark.conf.set(key, value)

    yield change
    for key, value in changed:
        if value is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, value)


def hot_alerts(spark, rows=60_000):
    """Alert occurrences, two thirds of which name one pass, in the order of `id`."""
    occurrences = spark.range(rows).repartition(16).select(
        F.col("id").alias("delivery_ord"),
        F.struct(F.col("id").alias("delivery_ord"), F.lit(0).alias("pos")).alias("ord"),
        F.concat(F.lit("a"), F.col("id")).alias("alert_id"),
        F.when(F.col("id") % 3 != 0, "hot").when(F.col("id") % 2 == 0, F.concat(F.lit("p"), F.col("id") % 500)).alias("related_pass_id"),
        F.repeat(F.lit("d"), 50).alias("description"),
    )
    passes = spark.range(500).select(F.concat(F.lit("p"), F.col("id")).alias("pass_id"), F.lit(0).cast("long").alias("first_ord"))
    hot = spark.range(1).select(F.lit("hot").alias("pass_id"), F.lit(100).cast("long").alias("first_ord"))
    return occurrences, passes.unionByName(hot)


def test_hot_pass_is_split_over_tasks(spark, settings_of):
    settings_of(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="200KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="100KB",
        spark__sql__adaptive__coalescePartitions__enabled="false",
    )
    occurrences, passes = hot_alerts(spark)
    linked = station.linked_alerts(occurrences, passes)
    linked.collect()
    final = plan(linked)
    assert "skew=true" in final.lower()
    found = {r.k: r["count"] for r in linked.groupBy(F.coalesce("related_pass_id", F.lit("-")).alias("k")).count().collect()}
    assert found["hot"] == 40_000 - 66 and found["-"] == 10_000
    assert sum(found.values()) == 60_000 - 66


def test_alerts_without_pass_are_spread(spark, settings_of):
    settings_of(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__enabled="false",
        spark__sql__shuffle__partitions="8",
    )
    occurrences, passes = hot_alerts(spark)
    linked = station.linked_alerts(occurrences.withColumn("related_pass_id", F.lit(None).cast("string")), passes)
    sizes = [r["count"] for r in linked.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 8 and max(sizes) < 2 * 60_000 / 8


@pytest.mark.parametrize("name", ["pass_summary_upsert", "key_creation_upsert", "schedule_upsert"])
def test_folds_combine_before_the_shuffle(spark, name):
    text = plan(entry_points.queries()[name](spark, SF_DIR))
    assert "partial_min_by" in text
    assert "Window" not in text and "collect_list" not in text


@pytest.mark.parametrize("name", ["key_count_parse", "latency_stats"])
def test_only_the_kind_wanted_is_searched(spark, name):
    lines = plan(entry_points.queries()[name](spark, SF_DIR)).splitlines()
    filters = [i for i, line in enumerate(lines) if "Filter" in line and "log_type" in line]
    searches = [i for i, line in enumerate(lines) if "regexp_extract" in line]
    # Deeper operators come later in the text: the kind is filtered below the search.
    assert max(filters) > max(searches)


def test_each_pattern_runs_once_a_line(spark):
    rows = spark.createDataFrame([(0, "a", created()), (1, "a", LATENCY)], "ord long, log_file string, value string")
    text = plan(keypool.rejected_lines(keypool.parse_lines(rows)))
    assert text.count("regexp_replace(") == 1
    for kind in keypool.KINDS:
        for field in kind.fields:
            assert text.count(field.pattern) == 1


def test_document_is_parsed_once(spark):
    text = plan(entry_points.queries()["env_flatten"](spark, SF_DIR))
    assert text.count("from_json") == 1
    assert "StructField(link," not in text


def test_hot_day_is_written_by_several_tasks(spark, settings_of, tmp_path):
    settings_of(spark__sql__adaptive__advisoryPartitionSizeInBytes="100KB")
    moment = F.lit("2024-01-01").cast("timestamp_ntz")
    rows = spark.range(60_000).repartition(16).select(
        (moment + F.make_dt_interval(days=F.when(F.col("id") % 3 == 0, F.col("id") % 40).otherwise(7))).alias("timestamp"),
        F.sha2(F.col("id").cast("string"), 256).alias("text"),
    )
    path = str(tmp_path / "by-day")
    write_by_day(rows, path)
    files = {}
    for name in spark.read.parquet(path).inputFiles():
        day = name.split("event_date=")[1].split("/")[0]
        files[day] = files.get(day, 0) + 1
    assert files["2024-01-08"] > 4 and len(files) == 40
    assert spark.read.parquet(path).count() == 60_000


def test_dedup_shuffles_flags_and_orders_only(spark):
    text = plan(entry_points.queries()["package_dedup"](spark, SF_DIR))
    assert "partial_min(" in text and "min_by" not in text


@pytest.mark.parametrize("name", ["alerts_ignore_fk", "active_alerts", "file_ledger_upsert", "new_files"])
def test_no_join_is_planned_as_a_broadcast(spark, name):
    text = plan(entry_points.queries()[name](spark, SF_DIR))
    assert "BroadcastHashJoin" not in text and "BroadcastNestedLoopJoin" not in text
