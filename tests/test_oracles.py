import pytest

from simsift.jobs import catalog
from tests.compare import same
from tests.conftest import SMALL


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_query_equals_sql(spark, name):
    same(spark, SMALL, catalog.QUERIES[name], catalog.ORACLES[name])


def test_entry_and_registry(spark):
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
    assert e.entry(spark).count() == 100
