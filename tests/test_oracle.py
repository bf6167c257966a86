import pytest
from conftest import DATA

from pedigrove import plans


@pytest.mark.parametrize("name", sorted(plans.QUERIES))
def test_query_equals_sql(spark, same, name):
    same(plans.QUERIES[name](spark, DATA), plans.SQL[name])


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
