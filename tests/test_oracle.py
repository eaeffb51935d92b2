"""Every registered query against its SQL, exactly."""

import pytest

from checks.compare import connect, difference
from checks.oracle import QUERIES
from roost.plans.registry import REGISTRY
from tests.conftest import SMALL


@pytest.fixture(scope="module")
def tables():
    return connect(SMALL)


def test_each_query_has_its_sql():
    assert sorted(REGISTRY) == sorted(QUERIES)
    assert len(REGISTRY) == 72


@pytest.mark.parametrize("name", list(REGISTRY))
def test_equal(spark, tables, name):
    assert difference(REGISTRY[name](spark, SMALL), tables, QUERIES[name]) is None


def test_entry_runs(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).columns == ["room_type", "revenue"]
    assert REGISTRY.keys() <= __spark_entry__.queries().keys()
    assert REGISTRY.keys() <= __spark_entry__.oracle_sql().keys() <= __spark_entry__.queries().keys()
