"""File catalogues: what lies in a landing folder, what is new, what is newest."""

from __future__ import annotations

import fnmatch

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.sources.logs import LOG_GLOB
from skyledger.sources.packages import PACKAGE_GLOB, is_package_name


LISTING = "path string, filename string, size long, modified timestamp"
LISTED_AT_ONCE = 10_000


# Levels of folders that are listed one by one, each folder by a task of its own, before the
# tasks walk what lies below.
SPREAD_LEVELS = 2


def list_files(spark: SparkSession, path: str, glob: str, levels: int = SPREAD_LEVELS) -> DataFrame:
    """path, filename, size and modification time of all files below `path`, empty ones too.

    The contents are never read, and the names never pass through the driver. Folders are dealt
    to tasks, level by level and then with all they hold, and a task hands its files on in
    pieces. `path` is the key: two folders may each have a file of one name. Names that start
    with a dot or an underscore are not listed.
    """

    def listing(deep: bool):
        """Lists the folders among its rows, with all below them if `deep`; passes files on."""

        def run(batches):
            import pyarrow as pa
            from pyarrow import fs

            system, base = fs.FileSystem.from_uri(path)
            fields = pa.schema(
                [
                    ("path", pa.string()),
                    ("filename", pa.string()),
                    ("size", pa.int64()),
                    ("modified", pa.timestamp("us", "UTC")),
                ]
            )

            def rows(found):
                columns = zip(*found, strict=True)
                arrays = [pa.array(c, type=f.type) for c, f in zip(columns, fields, strict=True)]
                return pa.RecordBatch.from_arrays(arrays, schema=fields)

            for batch in batches:
                found, waiting = [], []
                for row in batch.to_pylist():
                    # A folder has no name of a file; the first one is `path` itself.
                    if row["filename"] is None:
                        waiting.append(base if row["path"] is None else row["path"])
                    else:
                        found.append(tuple(row.values()))
                while waiting or found:
                    for info in system.get_file_info(fs.FileSelector(waiting.pop(), allow_not_found=True)) if waiting else ():
                        if info.base_name[:1] in "._":
                            continue
                        if info.type == fs.FileType.Directory:
                            if deep:
                                waiting.append(info.path)
                            else:
                                found.append((info.path, None, None, None))
                        elif fnmatch.fnmatchcase(info.base_name, glob):
                            found.append((info.path, info.base_name, info.size, info.mtime))
                    while len(found) >= LISTED_AT_ONCE or (found and not waiting):
                        yield rows(found[:LISTED_AT_ONCE])
                        found = found[LISTED_AT_ONCE:]

        return run

    none = F.lit(None)
    listed = spark.range(1).select(
        none.cast("string").alias("path"), none.cast("string").alias("filename"),
        none.cast("long").alias("size"), none.cast("timestamp").alias("modified"),
    )
    for _ in range(levels):
        listed = listed.mapInArrow(listing(False), LISTING).repartition("path")
    return listed.mapInArrow(listing(True), LISTING)


def list_folders(spark: SparkSession, path: str, folder: str) -> DataFrame:
    """The same for files that are folders of parts, named by a partition column."""
    parts = spark.read.format("binaryFile").load(path)
    return parts.groupBy(F.col(folder).alias("filename")).agg(
        F.sum("length").alias("size"), F.max("modificationTime").alias("modified")
    )


def log_catalogue(spark: SparkSession, path: str, folder: str | None = None) -> DataFrame:
    """All log files by name, with the address under which each is read."""
    files = list_folders(spark, path, folder) if folder else list_files(spark, path, LOG_GLOB)
    listed = files.withColumn("download_url", F.concat(F.lit("/logs/"), "filename"))
    return listed.orderBy("filename", *[c for c in ("path",) if c in listed.columns])


def package_files(spark: SparkSession, path: str) -> DataFrame:
    return list_files(spark, path, PACKAGE_GLOB).orderBy("filename", "path")


def latest_package_file(spark: SparkSession, path: str) -> DataFrame:
    """The file of the greatest package name, or no row; no document is read."""
    files = list_files(spark, path, PACKAGE_GLOB).where(is_package_name(F.col("filename")))
    return files.orderBy(F.desc("filename"), F.desc("path")).limit(1)


def new_files(catalogue: DataFrame, ledger: DataFrame) -> DataFrame:
    """Catalogue rows whose name the ledger does not hold."""
    return catalogue.join(ledger.select("filename"), "filename", "left_anti")


def name_ledger(spark: SparkSession, path: str) -> DataFrame:
    """A plain-text ledger, one file name a line; blank lines do not count."""
    name = F.trim("value")
    return spark.read.text(path).select(name.alias("filename")).where("filename <> ''").distinct()


def mark_processed(names: DataFrame, path: str) -> None:
    """Append names to a plain-text ledger."""
    names.select(F.col("filename").alias("value")).write.mode("append").text(path)


def package_list(packages: DataFrame) -> DataFrame:
    """Names of the packages, each once, sorted; other files do not count."""
    return (
        packages.where(is_package_name(F.col("file_name")))
        .select("file_name")
        .distinct()
        .orderBy("file_name")
    )


def latest_package(packages: DataFrame) -> DataFrame:
    """The package of the greatest file name, or no row. Names are compared first; only the
    documents of the greatest go on."""
    named = packages.where(is_package_name(F.col("file_name")))
    greatest = named.agg(F.max("file_name")).scalar()
    return named.where(F.col("file_name") == greatest).orderBy(F.desc("ord")).limit(1)


def package_by_name(packages: DataFrame, name: str) -> DataFrame:
    """The package of that name; a name of another shape finds nothing."""
    column = F.col("file_name")
    return packages.where(is_package_name(column) & (column == name))
