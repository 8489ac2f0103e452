"""A training corpus from raw documents: filter, deduplicate, redact, mix, pack.

Each stage takes what the one before it kept, as a written table, and works on all of it.
All but the last return the columns of `documents`; the last returns packed pieces with
their token ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.llm import minhash, mixing, packing, quality, secrets
from skyledger.llm.common import ship_package, stored, table


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, taught by `labels`, does not reject."""
    ship_package(spark)
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each near-duplicate class."""
    ship_package(spark)
    return minhash.keep_one(docs)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with a mark in place of each secret, and lengths to match."""
    ship_package(spark)
    return secrets.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in training order, each as often as its source's share asks for."""
    ship_package(spark)
    return mixing.mixed(docs)


def as_written(docs: DataFrame) -> DataFrame:
    """Rows of a table read from files, in the order they were written.

    A scan reads files by their size. Part files are numbered in the order of the partitions
    written; a partition's further files follow by name.
    """
    path = F.col("_metadata.file_path")
    number = F.regexp_extract(path, r"part-(\d+)[^/]*$", 1).try_cast("long")
    place = F.struct(number.alias("part"), path.alias("path"), F.col("_metadata.row_index").alias("row"))
    rows = docs.select(F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("row"), place.alias("place"))
    return rows.repartitionByRange("place").sortWithinPartitions("place").select("row.*")


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token windows in training order: one row per piece. `docs` is read from files."""
    ship_package(spark)
    return packing.pack(as_written(docs), packing.default_tokenizer())


STAGES = [
    ("quality", keep_quality),
    ("near_duplicates", drop_near_duplicates),
    ("secrets", redact_secrets),
    ("mixing", mix_sources),
    ("packing", pack_windows),
]

# A trained classifier, sketches, likelihood ratios and a tokenizer have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each result but the last is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
