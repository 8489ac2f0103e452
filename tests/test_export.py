import datetime as dt

from skyledger.plans import export

SCHEMA = "id int, text string, value double, moment timestamp_ntz, flag boolean"
ROWS = [
    (1, 'a,"b"\n c', 0.1, dt.datetime(2024, 1, 1, 2, 3, 4, 567000), True),
    (2, None, None, None, None),
    (3, "tab\there", 1e-300, dt.datetime(2024, 1, 1), False),
]


def test_csv_keeps_commas_quotes_and_nulls(spark, tmp_path):
    frame = spark.createDataFrame([r for r in ROWS if r[0] != 1], SCHEMA)
    export.export_csv(frame, str(tmp_path / "csv"))
    assert sorted(export.read_csv(spark, str(tmp_path / "csv"), frame.schema).collect()) == sorted(frame.collect())
    quoted = spark.createDataFrame([(1, 'a,"b", c\\')], "id int, text string")
    export.export_csv(quoted, str(tmp_path / "quoted"))
    assert export.read_csv(spark, str(tmp_path / "quoted"), quoted.schema).collect() == quoted.collect()


def test_line_ends_survive_the_export(spark, tmp_path):
    frame = spark.createDataFrame(ROWS, SCHEMA)
    export.export_csv(frame, str(tmp_path / "csv"))
    assert sorted(export.read_csv(spark, str(tmp_path / "csv"), frame.schema).collect()) == sorted(frame.collect())


def test_dump_full_schema_only_and_data_only(spark, tmp_path):
    frame = spark.createDataFrame(ROWS, SCHEMA)
    export.dump({"t": frame}, str(tmp_path / "full"))
    assert sorted(export.restore(spark, str(tmp_path / "full"), "t").collect()) == sorted(frame.collect())
    export.dump({"t": frame}, str(tmp_path / "schema"), data=False)
    assert export.read_schema(spark, str(tmp_path / "schema"), "t") == frame.schema
    assert not (tmp_path / "schema" / "data").exists()
    export.dump({"t": frame}, str(tmp_path / "data"), schema=False)
    assert not (tmp_path / "data" / "schema").exists()


def test_table_stats(spark):
    stats = export.table_stats({"a": spark.range(3), "b": spark.range(0)})
    assert {r.table_name: r.records for r in stats.collect()} == {"a": 3, "b": 0}
