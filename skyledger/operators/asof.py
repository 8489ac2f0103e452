"""As-of joins: for each moment of a series the newest row of every stream up to then.

The streams and the moments are put into one table, sorted by time, and each stream's newest
row is carried down to the moments. Time is cut into slices, so a station with most of the rows
is many tasks: a slice starts from what the slices before it leave, which is an aggregate that
combines before it is shuffled, one row per station and slice.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SLICE_SECONDS = 3600
MOMENT = "moment"
# Slice of all rows before the first moment: they are aggregated and never sorted.
BEFORE = -1
_SEED, _ROW, _ASKED = 0, 1, 2


@dataclass(frozen=True)
class Series:
    """Moments from `start` to `end`, both included, `every` so many seconds."""

    start: str
    end: str
    every: int = 10
    slice_seconds: int = SLICE_SECONDS

    def _edge(self, text: str) -> Column:
        return F.lit(text).cast("timestamp_ntz")

    def moments(self, stations: DataFrame) -> DataFrame:
        """The moments of each station: one row per station given, its columns kept."""
        step = F.make_dt_interval(secs=F.lit(self.every))
        return stations.withColumn(MOMENT, F.explode(F.sequence(self._edge(self.start), self._edge(self.end), step)))

    def slice_of(self, time: Column) -> Column:
        """Which slice a time falls in; BEFORE for all times before the start."""
        seconds = F.timestamp_diff("SECOND", self._edge(self.start), time)
        return F.when(time < self._edge(self.start), BEFORE).otherwise(F.floor(seconds / self.slice_seconds)).cast("int")

    def sliced(self, rows: DataFrame, time: str) -> DataFrame:
        """Rows up to the end that have a time, with their slice."""
        return rows.where(F.col(time) <= self._edge(self.end)).withColumn("slice", self.slice_of(F.col(time)))


@dataclass(frozen=True)
class Stream:
    """Rows of one kind: their time, the order of rows of one time, and what is carried."""

    rows: DataFrame
    time: str
    payload: Column
    order: str = "ord"


def asof(series: Series, streams: dict[str, Stream], stations: DataFrame) -> DataFrame:
    """One row per station and moment: the station's columns, `moment`, and for each stream its
    newest payload up to the moment, NULL where there is none.

    The streams have the station's columns. Of rows of one time the last by order counts; rows
    without a time never do.
    """
    by = stations.columns
    kinds = {name: (f"_v_{name}", f"_o_{name}") for name in streams}
    rows = reduce(
        lambda a, b: a.unionByName(b, allowMissingColumns=True),
        [
            series.sliced(s.rows, s.time).select(
                *by,
                "slice",
                F.col(s.time).alias("_time"),
                s.payload.alias(kinds[name][0]),
                F.struct(F.col(s.time).alias("time"), F.col(s.order).alias("ord")).alias(kinds[name][1]),
            )
            for name, s in streams.items()
        ],
    )
    moments = series.moments(stations).withColumn("slice", series.slice_of(F.col(MOMENT)))
    left = rows.groupBy(*by, "slice").agg(*[F.max_by(v, o).alias(v) for v, o in kinds.values()])
    seeds = _carried_in(left, moments, by, [v for v, _ in kinds.values()]).withColumn("_kind", F.lit(_SEED))
    inside = rows.where(F.col("slice") > BEFORE).withColumn("_kind", F.lit(_ROW))
    asked = moments.withColumns({"_kind": F.lit(_ASKED), "_time": F.col(MOMENT)})
    whole = seeds.unionByName(inside, allowMissingColumns=True).unionByName(asked, allowMissingColumns=True)
    # A row at the very moment counts, so it comes before it.
    order = Window.partitionBy(*by, "slice").orderBy(F.col("_kind") > _SEED, "_time", "_kind", *[o for _, o in kinds.values()])
    down = order.rowsBetween(Window.unboundedPreceding, 0)
    found = whole.select(
        *by, "_kind", MOMENT, *[F.last(v, ignorenulls=True).over(down).alias(name) for name, (v, _) in kinds.items()]
    )
    return found.where(F.col("_kind") == _ASKED).drop("_kind")


def _carried_in(left: DataFrame, moments: DataFrame, by: list[str], values: list[str]) -> DataFrame:
    """What each slice with moments starts from: the newest of what the slices before it leave.

    A row per station and slice at most, however many rows those hold.
    """
    marks = moments.select(*by, "slice").distinct().withColumn("_kind", F.lit(_SEED))
    through = Window.partitionBy(*by).orderBy("slice", "_kind").rowsBetween(Window.unboundedPreceding, 0)
    told = left.withColumn("_kind", F.lit(_ROW)).unionByName(marks, allowMissingColumns=True)
    carried = [F.last(v, ignorenulls=True).over(through).alias(v) for v in values]
    return told.select(*by, "slice", "_kind", *carried).where(F.col("_kind") == _SEED).drop("_kind")


def last_rows(
    series: Series, rows: DataFrame, time: str, item: Column, size: int, stations: DataFrame, order: str = "ord"
) -> Stream:
    """A stream whose payload is the `size` newest items up to each row, newest first.

    A bounded frame holds them. A slice starts with the newest rows before it, of which each
    earlier slice offers `size` at most.
    """
    by = stations.columns
    plain = series.sliced(rows, time).select(
        *by, "slice", F.col(time).alias("_time"), F.col(order).alias("ord"), item.alias("item")
    )
    latest = Window.partitionBy(*by, "slice").orderBy(F.desc("_time"), F.desc("ord"))
    few = plain.withColumn("_n", F.row_number().over(latest)).where(F.col("_n") <= size).drop("_n")
    held = Window.partitionBy(*by).orderBy("_time", "ord").rowsBetween(1 - size, 0)
    recent = F.collect_list(F.struct("_time", "ord", "item")).over(held)
    left = few.withColumn("recent", recent).groupBy(*by, "slice").agg(F.max_by("recent", F.struct("_time", "ord")).alias("recent"))
    moments = series.moments(stations).withColumn("slice", series.slice_of(F.col(MOMENT)))
    seeds = (
        _carried_in(left, moments, by, ["recent"])
        .select(*by, "slice", F.explode("recent").alias("entry"))
        .select(*by, "slice", "entry.*", F.lit(True).alias("_seed"))
    )
    inside = plain.where(F.col("slice") > BEFORE).unionByName(few.where(F.col("slice") == BEFORE))
    ordered = Window.partitionBy(*by, "slice").orderBy("_time", "ord")
    gathered = F.collect_list("item").over(ordered.rowsBetween(1 - size, 0))
    told = (
        seeds.unionByName(inside.withColumn("_seed", F.lit(False)))
        .select(*by, "_time", "ord", "_seed", F.reverse(gathered).alias("recent"))
        .where(~F.col("_seed"))
    )
    return Stream(told, "_time", F.col("recent"))
