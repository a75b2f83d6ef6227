"""Every registered query against its SQL counterpart, on whole tables."""

import oracle
import pytest
from support import SF, plan, single_task_steps

from __spark_entry__ import entry, queries
from workloads.registry import ORACLES, QUERIES


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    """The rows of the SQL, and a plan that no table size can turn against itself."""
    assert name in ORACLES
    df = QUERIES[name](spark, SF)
    text = plan(df)
    for operator in ("CartesianProduct", "NestedLoop", "EvalPython", "InPandas", "FlatMapGroups"):
        assert operator not in text
    # nothing is sorted or windowed in one task but the seven stages of the funnel
    if name != "payment_funnel":
        assert not {"Window", "Sort"} & set(single_task_steps(text))
    assert oracle.compare(df, con, ORACLES[name]) is None


def test_every_oracle_has_a_query():
    assert set(ORACLES) == set(QUERIES) <= set(queries())


def test_entry(spark):
    assert entry(spark).count() > 0
