"""Key-pool log files as rows of lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LOG_GLOB = "*.log"


def _with_metadata(reader, path: str, glob: str | None, folder: str | None) -> DataFrame:
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.text(path).select(
        "value",
        F.col(folder or "_metadata.file_name").alias("log_file"),
        F.col("_metadata.file_size").alias("file_size"),
        F.col("_metadata.file_name").alias("part"),
        F.col("_metadata.file_block_start").alias("block_start"),
    )


def with_arrival_order(lines: DataFrame) -> DataFrame:
    """Number the lines in file order: by file name, split, and position in the split.

    The id is taken before any shuffle, so positions follow the file. Batch only; a
    stream takes it inside its micro-batch.
    """
    row = F.monotonically_increasing_id().alias("row")
    order = F.struct("log_file", "part", "block_start", row)
    return lines.withColumn("ord", order).drop("part", "block_start")


def read_log_lines(
    spark: SparkSession, path: str, glob: str | None = LOG_GLOB, folder: str | None = None
) -> DataFrame:
    """Lines of all log files: value, log_file, file_size, ord.

    A log may also be a folder of parts, as Spark writes it; `folder` then names the
    partition column that holds the log's name.
    """
    return with_arrival_order(_with_metadata(spark.read, path, glob, folder))


def stream_log_lines(
    spark: SparkSession,
    path: str,
    max_files: int,
    glob: str | None = LOG_GLOB,
    folder: str | None = None,
    archive: str | None = None,
) -> DataFrame:
    """The same lines as an unbounded stream, before the arrival order is taken."""
    return _with_metadata(landing_reader(spark, max_files, archive), path, glob, folder)


def landing_reader(spark: SparkSession, max_files: int, archive: str | None = None):
    """A reader of files as they land. With `archive`, files that are done move there, so the
    landing folder holds only what is still to be read."""
    reader = spark.readStream.option("maxFilesPerTrigger", max_files)
    return reader.option("cleanSource", "archive").option("sourceArchiveDir", archive) if archive else reader
