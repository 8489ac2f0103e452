"""Upserts as folds over append-only rows.

A keyed table is never updated in place. Each key folds into one row: some columns keep
the value of the earliest row, the others take the value of the newest, NULL included.
A fold state (the two half rows with their order keys) merges with other states in any
order, so partial results combine on the map side, a key with a third of all rows costs
one partial row per task, and a written snapshot can stand in for everything it covers.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.functions.rows import collated

KEY, FIRST, LAST, FIRST_ORD, LAST_ORD, LOOSE = "_key", "_first", "_last", "first_ord", "last_ord", "_loose"


def _group_key(key: str, order: Column, collation: str | None) -> list[Column]:
    """The key, and for a NULL key the row itself: rows without a key never meet."""
    column = collated(F.col(key), collation)
    return [column.alias(KEY), F.when(F.col(key).isNull(), order).alias(LOOSE)]


def fold_state(
    rows: DataFrame,
    key: str,
    order: str = "ord",
    replaces: list[str] = (),
    collation: str | None = None,
) -> DataFrame:
    """Fold state of `rows`: every column but the order key is kept."""
    ordering = F.col(order)
    kept = [c for c in rows.columns if c != order]
    aggregates = [
        F.min_by(F.struct(*kept), ordering).alias(FIRST),
        F.min(ordering).alias(FIRST_ORD),
    ]
    if replaces:
        aggregates.append(F.max_by(F.struct(*replaces), ordering).alias(LAST))
    aggregates.append(F.max(ordering).alias(LAST_ORD))
    return rows.groupBy(*_group_key(key, ordering, collation)).agg(*aggregates)


def merge_states(*states: DataFrame) -> DataFrame:
    """One state out of several, e.g. a snapshot and what came after it."""
    union = reduce(lambda a, b: a.unionByName(b), states)
    aggregates = [F.min_by(FIRST, FIRST_ORD).alias(FIRST), F.min(FIRST_ORD).alias(FIRST_ORD)]
    if LAST in union.columns:
        aggregates.append(F.max_by(LAST, LAST_ORD).alias(LAST))
    aggregates.append(F.max(LAST_ORD).alias(LAST_ORD))
    return union.groupBy(KEY, LOOSE).agg(*aggregates)


def fold_result(state: DataFrame, with_order: bool = False) -> DataFrame:
    """The table a state stands for, in the column order of its rows."""
    replaced = state.schema[LAST].dataType.names if LAST in state.columns else []
    columns = [
        F.col(f"{LAST if name in replaced else FIRST}.{name}").alias(name)
        for name in state.schema[FIRST].dataType.names
    ]
    if with_order:
        columns += [F.col(FIRST_ORD), F.col(LAST_ORD)]
    return state.select(*columns)


def fold(
    rows: DataFrame,
    key: str,
    order: str = "ord",
    replaces: list[str] = (),
    collation: str | None = None,
    with_order: bool = False,
) -> DataFrame:
    """One row per key. `replaces` take their newest value, all others their first.

    `collation` compares the keys under a collation instead of byte by byte.
    """
    return fold_result(fold_state(rows, key, order, replaces, collation), with_order)
