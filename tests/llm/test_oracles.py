"""The operators' queries against their SQL on the smallest tables."""

import pytest

from tests.oracle import compare
from tracewright.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, name):
    compare(spark, name, QUERIES[name], ORACLES[name], "/root/testdata/sf0.001")
