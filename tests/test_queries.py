"""Every registered query of the episode engine against its SQL."""

import pytest

from tests.oracle import compare
from tracewright.plans import catalog

D = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(catalog.oracles()))
def test_query(spark, name):
    compare(spark, name, catalog.queries()[name], catalog.oracles()[name], D)


def test_every_query_has_sql():
    assert set(catalog.queries()) == set(catalog.oracles())


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
