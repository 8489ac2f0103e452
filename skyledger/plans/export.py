"""Table statistics, CSV export and table dumps."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def table_stats(tables: dict[str, DataFrame]) -> DataFrame:
    """Number of records per table. Of a table stored as files only the footers are read."""
    counts = [
        rows.agg(F.count(F.lit(1)).alias("records")).select(F.lit(name).alias("table_name"), "records")
        for name, rows in tables.items()
    ]
    return reduce(lambda a, b: a.unionByName(b), counts)


def export_csv(rows: DataFrame, path: str) -> None:
    """Write a table as CSV parts with a header and proper quoting."""
    rows.write.mode("errorifexists").option("header", True).option("escape", '"').csv(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Read an export back under its schema. Quoted text may hold line ends, so a part is
    read as a whole; the parts of an export are what its reading is spread over."""
    reader = spark.read.schema(schema).option("header", True).option("escape", '"')
    return reader.option("multiLine", True).csv(path)


def dump(tables: dict[str, DataFrame], path: str, schema: bool = True, data: bool = True) -> None:
    """Write tables below `path`: their schemas as JSON text, their rows as Parquet."""
    for name, rows in tables.items():
        if schema:
            text = rows.sparkSession.createDataFrame([(rows.schema.json(),)], "value string")
            text.coalesce(1).write.mode("errorifexists").text(f"{path}/schema/{name}")
        if data:
            rows.write.mode("errorifexists").parquet(f"{path}/data/{name}")


def read_schema(spark: SparkSession, path: str, name: str) -> T.StructType:
    """The schema of a dumped table."""
    import json

    text = spark.read.option("wholetext", True).text(f"{path}/schema/{name}").first()["value"]
    return T.StructType.fromJson(json.loads(text))


def restore(spark: SparkSession, path: str, name: str) -> DataFrame:
    """A dumped table under its dumped schema."""
    return spark.read.schema(read_schema(spark, path, name)).parquet(f"{path}/data/{name}")
