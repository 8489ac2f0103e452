import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from skyledger.operators.fold import fold, fold_result, fold_state, merge_states

SCHEMA = "k string, a int, b int, ord long"


def expected(rows):
    """Replay in order: insert, and on a repeat replace `b` only."""
    table, loose = {}, []
    for k, a, b, _ in sorted(rows, key=lambda r: r[3]):
        if k is None:
            loose.append((None, a, b))
        elif k in table:
            table[k] = (k, table[k][1], b)
        else:
            table[k] = (k, a, b)
    return sorted([*table.values(), *loose], key=repr)


def collected(frame):
    return sorted([tuple(r) for r in frame.collect()], key=repr)


values = st.one_of(st.none(), st.integers(0, 3))
row_lists = st.lists(st.tuples(st.sampled_from(["x", "y", None]), values, values), max_size=12)


@settings(max_examples=8, deadline=None)
@given(row_lists, st.integers(0, 12))
def test_fold_replays_the_upsert(spark, rows, cut):
    rows = [(*r, i) for i, r in enumerate(rows)]
    shuffled = random.Random(1).sample(rows, len(rows))
    frame = spark.createDataFrame(shuffled, SCHEMA)
    assert collected(fold(frame, "k", replaces=["b"])) == expected(rows)
    # A state of the early rows merged with one of the late rows is the state of all.
    early = fold_state(frame.where(f"ord < {cut}"), "k", replaces=["b"])
    late = fold_state(frame.where(f"ord >= {cut}"), "k", replaces=["b"])
    assert collected(fold_result(merge_states(late, early))) == expected(rows)


def test_newest_null_is_kept(spark):
    frame = spark.createDataFrame([("x", 1, 5, 0), ("x", 2, None, 1)], SCHEMA)
    assert collected(fold(frame, "k", replaces=["b"])) == [("x", 1, None)]


def test_without_replacement_the_first_row_stays(spark):
    frame = spark.createDataFrame([("x", 2, 2, 5), ("x", 1, None, 3), (None, 1, 1, 1), (None, 2, 2, 2)], SCHEMA)
    assert collected(fold(frame, "k")) == sorted([("x", 1, None), (None, 1, 1), (None, 2, 2)], key=repr)


@pytest.mark.parametrize(
    "collation, groups", [(None, 4), ("UNICODE_CI_AI", 2), ("UNICODE_CI_RTRIM", 2)]
)
def test_collated_keys(spark, collation, groups):
    keys = {None: ["é", "E", "e ", "x"], "UNICODE_CI_AI": ["é", "E", "e", "x"], "UNICODE_CI_RTRIM": ["e", "E", "e ", "x"]}
    rows = [(k, i, i, i) for i, k in enumerate(keys[collation])]
    folded = fold(spark.createDataFrame(rows, SCHEMA), "k", replaces=["b"], collation=collation).collect()
    assert len(folded) == groups
    if collation:
        assert {(r.a, r.b) for r in folded} == {(0, 2), (3, 3)}


def test_order_keys_may_be_structs(spark):
    frame = spark.createDataFrame(
        [("x", 1, 1, ("b", 0)), ("x", 2, 2, ("a", 9)), ("x", 3, 3, ("a", 10))],
        "k string, a int, b int, ord struct<f: string, n: int>",
    )
    assert collected(fold(frame, "k", replaces=["b"])) == [("x", 2, 1)]
