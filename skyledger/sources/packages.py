"""Station packages as rows of typed sections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.functions.rows import computed_once
from skyledger.schemas import SECTIONS, package_schema
from skyledger.sources.logs import landing_reader, read_log_lines, stream_log_lines, with_arrival_order

PACKAGE_GLOB = "package_*.json"
PACKAGE_NAME = r"\Apackage_.*\.json\z"


def is_package_name(name: Column) -> Column:
    return name.rlike(PACKAGE_NAME)


def _lift_sections(documents: DataFrame, sections: list[str]) -> DataFrame:
    return documents.select(
        "file_name",
        "ord",
        "package_timestamp",
        "collector_id",
        "ogs_provider",
        *[F.col(f"data.{section}").alias(section) for section in sections],
        "logs",
    )


def parse_documents(
    documents: DataFrame, sections: list[str] = tuple(SECTIONS), text: str = "document"
) -> DataFrame:
    """Packages from a column of JSON text next to file_name and ord.

    A document is parsed once, and only the sections asked for are built.
    """
    parsed = computed_once(
        documents.select("file_name", "ord", text),
        package=F.from_json(text, package_schema(sections)),
    )
    return _lift_sections(parsed.select("file_name", "ord", "package.*"), sections)


def read_packages(
    spark: SparkSession, path: str, sections: list[str] = tuple(SECTIONS)
) -> DataFrame:
    """Every package file below `path`. A half-written document has NULL sections."""
    return _documents(spark.read, path, sections)


def read_package_lines(
    spark: SparkSession, path: str, sections: list[str] = tuple(SECTIONS)
) -> DataFrame:
    """Packages merged into larger files, one document a line, which a scan can split."""
    lines = read_log_lines(spark, path, glob=None)
    documents = lines.select(F.col("log_file").alias("file_name"), "ord", F.col("value").alias("document"))
    return parse_documents(documents, sections)


def stream_packages(spark: SparkSession, path: str, max_files: int, archive: str | None = None) -> DataFrame:
    """Every package file as it lands."""
    return _documents(landing_reader(spark, max_files, archive), path, SECTIONS)


def stream_package_lines(spark: SparkSession, path: str, max_files: int) -> DataFrame:
    """Merged package files as they land, one document a line, before the arrival order."""
    return stream_log_lines(spark, path, max_files, glob=None)


def package_line_batch(lines: DataFrame, sections: list[str] = tuple(SECTIONS)) -> DataFrame:
    """The packages of a micro-batch of merged files, in the order of their lines."""
    ordered = with_arrival_order(lines)
    documents = ordered.select(F.col("log_file").alias("file_name"), "ord", F.col("value").alias("document"))
    return parse_documents(documents, sections)


def _documents(reader, path: str, sections: list[str]) -> DataFrame:
    documents = (
        reader.schema(package_schema(sections))
        .option("multiLine", True)
        .option("pathGlobFilter", PACKAGE_GLOB)
        .json(path)
        .select("*", F.col("_metadata.file_name").alias("file_name"))
    )
    return _lift_sections(documents.withColumn("ord", F.struct("file_name")), sections)
