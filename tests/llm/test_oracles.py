"""Queries against their SQL counterparts, on whole tables."""

import oracle
import pytest

from tidemark.llm.oracles import ORACLES
from tidemark.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, name):
    assert oracle.compare(QUERIES[name](spark, SF), oracle.connect(SF), ORACLES[name]) is None
