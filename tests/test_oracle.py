"""Every registered query against its SQL twin on the smallest tables."""

import os

import pytest
from oracle import connect, differences

import __spark_entry__ as entry_points
from skyledger.bindings.oracles import oracle_sql
from skyledger.bindings.queries import REGISTRY

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def connection():
    return connect(SF_DIR)


def test_every_query_has_a_twin():
    assert set(REGISTRY) == set(oracle_sql())
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0


NEVER_PLANNED = ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "EvalPython", "collect_set")


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query(spark, connection, name):
    frame = REGISTRY[name](spark, SF_DIR)
    assert differences(frame, connection, oracle_sql()[name]) == []
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert [word for word in NEVER_PLANNED if word in plan] == []
