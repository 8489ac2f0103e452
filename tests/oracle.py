"""Compare the registered queries with their SQL twins in DuckDB."""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return connection


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.12g}")
    return value


def normalised(columns: list[str], rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=columns.__getitem__)
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(plain, key=repr)


def is_ordered(sql: str) -> bool:
    """Whether the statement itself, not a part of it, sorts its rows."""
    depth, outer = 0, []
    for character in sql:
        depth += (character == "(") - (character == ")")
        outer.append(character if depth == 0 else " ")
    return "ORDER BY" in "".join(outer)


def in_order(columns: list[str], rows, key: str) -> list:
    place = columns.index(key)
    return [_plain(row[place]) for row in rows]


def differences(spark_frame, connection, sql: str) -> list[str]:
    spark_rows = spark_frame.collect()
    left_columns, left = normalised(spark_frame.columns, spark_rows)
    cursor = connection.execute(sql)
    sql_rows = cursor.fetchall()
    sql_columns = [d[0] for d in cursor.description]
    right_columns, right = normalised(sql_columns, sql_rows)
    if left_columns != right_columns:
        return [f"columns {left_columns} != {right_columns}"]
    found = [] if left or right else ["no rows on either side"]
    if is_ordered(sql):
        # Rows that tie in the order may change places, so the sorted column is compared.
        for key in ("timestamp", "time_sec", "date", "start_time", "filename", "file_name"):
            if key in left_columns:
                if in_order(spark_frame.columns, spark_rows, key) != in_order(sql_columns, sql_rows, key):
                    found.append(f"order by {key} differs")
                break
    if len(left) != len(right):
        found.append(f"{len(left)} rows != {len(right)}")
    types = {d[0]: str(d[1]) for d in cursor.description}
    spark_types = dict(spark_frame.dtypes)
    same = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
            "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP"}
    for name in left_columns:
        if same.get(spark_types[name], spark_types[name]) != types[name]:
            found.append(f"type of {name}: {spark_types[name]} != {types[name]}")
    if left != right:
        left_rows, right_rows = set(left), set(right)
        missing = [row for row in left if row not in right_rows][:2]
        extra = [row for row in right if row not in left_rows][:2]
        found.append(f"only spark {missing} only sql {extra}")
    return found


if __name__ == "__main__":
    import os

    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as entry_points
    from skyledger.session import build_session

    sf_dir = sys.argv[1]
    wanted = sys.argv[2:]
    spark = build_session("oracle", "local[8]", **{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "8",
                                                    "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(sf_dir)
    oracles = entry_points.oracle_sql()
    bad = 0
    for name, query in entry_points.queries().items():
        if wanted and name not in wanted:
            continue
        started = time.time()
        try:
            if name not in oracles:
                found = [f"rows only: {query(spark, sf_dir).count()}"]
            else:
                found = differences(query(spark, sf_dir), connection, oracles[name])
        except Exception as error:  # report and go on
            found = [f"{type(error).__name__}: {str(error)[:900]}"]
        bad += bool(found)
        print(f"{'FAIL' if found else 'ok  '} {name} {time.time() - started:.1f}s {' | '.join(found)[:1500]}", flush=True)
    print("failed", bad)
