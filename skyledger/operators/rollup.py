"""Daily aggregates that are kept up to date from changes instead of being worked out anew.

A change is a row with a weight: 1 where a row came to be, -1 where one is no more. An upsert is
a change of each kind. Counts add up; a least and a greatest value merge as long as no change
takes one of them away. Where one does, the group alone is worked out from all its changes.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WEIGHT = "weight"
COUNT, LEAST, GREATEST = "rows", "least", "greatest"


@dataclass(frozen=True)
class Rollup:
    """Rows, least and greatest `value` per group; `day` is the group's date."""

    name: str
    group: tuple[str, ...]
    value: str
    day: str = "date"

    @property
    def columns(self) -> list[str]:
        return [*self.group, COUNT, LEAST, GREATEST]


def net(changes: DataFrame, columns: list[str]) -> DataFrame:
    """The changes summed by some columns; what came and went again is gone."""
    return changes.groupBy(*columns).agg(F.sum(WEIGHT).alias(WEIGHT)).where(F.col(WEIGHT) != 0)


def delta(changes: DataFrame, rollup: Rollup) -> DataFrame:
    """Per group how its rows change: how many more, and the ends of the values that came and
    of those that went. Deltas of some batches together are the delta of all their changes."""
    value = F.col(rollup.value)
    came, went = F.when(F.col(WEIGHT) > 0, value), F.when(F.col(WEIGHT) < 0, value)
    return (
        net(changes, [*rollup.group, rollup.value])
        .groupBy(*rollup.group)
        .agg(
            F.sum(WEIGHT).alias("more"),
            F.min(came).alias("came_least"),
            F.max(came).alias("came_greatest"),
            F.min(went).alias("went_least"),
            F.max(went).alias("went_greatest"),
        )
    )


def _same_group(left: str, right: str, group: tuple[str, ...]) -> Column:
    same = F.lit(True)
    for name in group:
        same = same & F.col(f"{left}.{name}").eqNullSafe(F.col(f"{right}.{name}"))
    return same


def _renewed(changed: DataFrame, before: DataFrame | None, rollup: Rollup) -> DataFrame:
    """The groups of a delta after it: group, rows, least, greatest, and whether one of the ends
    went away without a value beyond it, so that it has to be looked for."""
    names = [F.col(f"d.{name}").alias(name) for name in rollup.group]
    if before is None:
        told = changed.alias("d").select(
            *names, F.col("more").alias(COUNT), F.col("came_least").alias(LEAST), F.col("came_greatest").alias(GREATEST)
        )
        return told.withColumn("lost", F.lit(False))
    both = changed.alias("d").join(before.alias("b"), _same_group("d", "b", rollup.group), "left")
    least, greatest = F.col(f"b.{LEAST}"), F.col(f"b.{GREATEST}")
    rows = F.coalesce(F.col(f"b.{COUNT}"), F.lit(0)) + F.col("more")
    low = (F.col("went_least") <= least) & F.coalesce(F.col("came_least") > F.col("went_least"), F.lit(True))
    high = (F.col("went_greatest") >= greatest) & F.coalesce(F.col("came_greatest") < F.col("went_greatest"), F.lit(True))
    lost = F.coalesce(low, F.lit(False)) | F.coalesce(high, F.lit(False))
    return both.select(
        *names,
        rows.alias(COUNT),
        F.least(least, "came_least").alias(LEAST),
        F.greatest(greatest, "came_greatest").alias(GREATEST),
        (lost & (rows > 0)).alias("lost"),
    )


def roll(changes: DataFrame, before: DataFrame | None, history: DataFrame, rollup: Rollup) -> DataFrame:
    """The groups that some changes touch, as they are after them.

    `before` has the groups as they were, None at first. `history` has all changes up to and
    with these and is cut by the group's day; of it only the days of groups that have lost an
    end are read. A group without rows stays, with a count of 0.
    """
    told = _renewed(delta(changes, rollup), before, rollup)
    lost = told.where("lost").select(*rollup.group)
    first, last = (lost.agg(edge(rollup.day)).scalar() for edge in (F.min, F.max))
    days = history.where(F.col(rollup.day).between(first, last)).alias("h")
    of_lost = days.join(lost.alias("l"), _same_group("h", "l", rollup.group), "left_semi")
    ends = (
        net(of_lost, [*rollup.group, rollup.value])
        .groupBy(*rollup.group)
        .agg(F.min(rollup.value).alias("found_least"), F.max(rollup.value).alias("found_greatest"))
    )
    both = told.alias("t").join(ends.alias("e"), _same_group("t", "e", rollup.group), "left")
    empty = F.col(COUNT) == 0
    return both.select(
        *[F.col(f"t.{name}").alias(name) for name in rollup.group],
        COUNT,
        F.when(~empty, F.when(F.col("lost"), F.col("found_least")).otherwise(F.col(LEAST))).alias(LEAST),
        F.when(~empty, F.when(F.col("lost"), F.col("found_greatest")).otherwise(F.col(GREATEST))).alias(GREATEST),
    )
