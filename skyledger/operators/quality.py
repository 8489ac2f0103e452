"""Rows that fail a check, with the reason."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.functions.display import KEY_POOL_TYPES
from skyledger.operators.station import CHECKED_SECTIONS, _alert_items, _schedule_items, section_ok
from skyledger.schemas import REQUIRED_COLUMNS

# Value domains of stored columns.
DOMAINS = {"key_pool_type": KEY_POOL_TYPES}


def missing_columns(table: str) -> Column:
    """Names of the required columns that are empty."""
    return F.filter(
        F.array(*[F.when(F.col(c).isNull(), c) for c in REQUIRED_COLUMNS[table]]),
        lambda name: name.isNotNull(),
    )


def outside_domain(column: str) -> Column:
    """True when a column has a value its domain does not know."""
    return F.coalesce(~F.col(column).isin(DOMAINS[column]), F.lit(False))


def rejected_rows(rows: DataFrame, required: list[str], order: str = "ord") -> DataFrame:
    """Rows of a table that lack a required value or hold one their domain does not know.

    ord, missing (names of empty columns), outside (names of columns with a foreign value).
    """
    known = [c for c in DOMAINS if c in rows.columns]
    missing = F.filter(F.array(*[F.when(F.col(c).isNull(), c) for c in required]), lambda c: c.isNotNull())
    outside = F.filter(F.array(*[F.when(outside_domain(c), c) for c in known]), lambda c: c.isNotNull())
    checked = rows.select(
        order, missing.cast("array<string>").alias("missing"), outside.cast("array<string>").alias("outside")
    )
    return checked.where((F.size("missing") > 0) | (F.size("outside") > 0))


def rejected_sections(packages: DataFrame) -> DataFrame:
    """Sections, alerts and planned passes that reach no table, one row each.

    One pass over the packages: a package lists its rejects, the list is unfolded.
    """
    whole = [
        F.when(
            ~F.coalesce(section_ok(s), F.lit(False)),
            F.struct(
                F.lit(s).alias("section"),
                F.when(F.col(s).isNull(), "missing_section").otherwise("missing_required").alias("reason"),
            ),
        )
        for s in [*CHECKED_SECTIONS, "schedule"]
    ]
    found = F.filter(F.array(*whole), lambda r: r.isNotNull())
    sections = packages.select("ord", "package_timestamp", F.inline(found).alias("section", "reason"))
    return sections


def rejected_items(settled: DataFrame) -> DataFrame:
    """Alerts without a time and planned passes without an id."""
    parts = {
        "ogs_alerts": _alert_items(settled).select("ord", *REQUIRED_COLUMNS["ogs_alerts"]),
        "ogs_pass_schedule": _schedule_items(settled).select(
            "ord", *REQUIRED_COLUMNS["ogs_pass_schedule"]
        ),
    }
    rejected = [
        rows.withColumn("missing", missing_columns(table))
        .where(F.size("missing") > 0)
        .select(F.lit(table).alias("table"), "ord", "missing")
        for table, rows in parts.items()
    ]
    return rejected[0].unionByName(rejected[1])
