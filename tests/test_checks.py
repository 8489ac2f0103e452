"""Checked rows: good and bad ones apart, counts as observed, replays without doubles."""

import datetime as dt

from skyledger.streaming import checks
from skyledger.streaming.warehouse import Warehouse

SCHEMA = (
    "key_identity string, sequence_number int, source_site_id int, destination_site_id int, key_pool_type string, "
    "timestamp timestamp_ntz, log_file string"
)
MOMENT = dt.datetime(2024, 1, 1)
GOOD = ("k", 1, 2, 3, "PUBLIC", MOMENT, "f")


def rows_of(spark, *rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(2)


def test_good_and_bad_rows_and_their_counts(spark, tmp_path):
    warehouse, table = Warehouse(str(tmp_path)), "key_creations"
    assert checks.accepted_rows(warehouse, spark, table) is None and checks.violation_counts(warehouse, spark, table) is None
    foreign, public = (*GOOD[:4], "FOREIGN", *GOOD[5:]), (*GOOD[:4], "public", *GOOD[5:])
    nameless, both = (None, *GOOD[1:]), (None, 1, None, 3, "X", MOMENT, "f")
    checks.store_checked(warehouse, rows_of(spark, GOOD, foreign, nameless), table, 0)
    for _ in range(2):  # a replayed batch
        checks.store_checked(warehouse, rows_of(spark, GOOD, GOOD, public, both), table, 1)
    assert [tuple(r) for r in checks.accepted_rows(warehouse, spark, table).select(*SCHEMA.replace(",", "").split()[::2]).collect()] == [GOOD] * 3
    bad = checks.quarantined_rows(warehouse, spark, table).collect()
    assert sorted(",".join(r.violations) for r in bad) == [
        "missing:key_identity", "missing:key_identity,missing:source_site_id,outside:key_pool_type",
        "outside:key_pool_type", "outside:key_pool_type",
    ]
    told = {r.violation: r.rows for r in checks.violation_counts(warehouse, spark, table).collect()}
    assert {k: v for k, v in told.items() if v} == {
        "rows": 7, "accepted": 3, "missing:key_identity": 2, "missing:source_site_id": 1, "outside:key_pool_type": 3,
    }


def test_an_empty_batch(spark, tmp_path):
    warehouse = Warehouse(str(tmp_path))
    checks.store_checked(warehouse, rows_of(spark, GOOD).limit(0), "key_creations", 0)
    assert {r.rows for r in checks.violation_counts(warehouse, spark, "key_creations").collect()} == {0}


def test_a_station_table_is_checked_by_its_own_columns(spark, tmp_path):
    warehouse = Warehouse(str(tmp_path))
    rows = spark.createDataFrame([(MOMENT, None), (None, "OGS-1"), (MOMENT, "OGS-1")], "timestamp timestamp_ntz, ogs_id string")
    checks.store_checked(warehouse, rows, "ogs_environment_data", 3)
    bad = checks.quarantined_rows(warehouse, spark, "ogs_environment_data").collect()
    assert sorted(r.violations for r in bad) == [["missing:ogs_id"], ["missing:timestamp"]]
