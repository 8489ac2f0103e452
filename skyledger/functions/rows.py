"""Row-level helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def computed_once(rows: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that are worked out once per row.

    A plain projection is merged with the filters above it, which repeats its expressions
    there; a regex chain then runs many times a line. Unfolding a one-element list keeps
    the values: what lies above reads them.
    """
    entry = F.struct(*[column.alias(name) for name, column in columns.items()])
    return rows.select("*", F.inline(F.array(entry)))


def spread_key(key: Column, row: Column) -> Column:
    """A join key whose NULLs are spread over all tasks instead of meeting in one.

    The made-up names may meet anything: the caller decides by the NULL of `key` itself.
    """
    return F.coalesce(key, F.xxhash64(row).cast("string"))


def collated(key: Column, collation: str | None) -> Column:
    """The key under a collation, or as it is."""
    return F.collate(key, collation) if collation else key
