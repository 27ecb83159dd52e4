import pytest

from lociq import catalog
from tests.oracle import connect, same

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query_equals_its_sql(spark, con, name):
    if name not in catalog.oracle_sql():  # random rows
        sizes = [r.isize for r in catalog.queries()[name](spark, SF).collect()]
        assert len(sizes) > 1900 and all(150 <= x <= 250 for x in sizes) and abs(sum(sizes) / len(sizes) - 200) < 2
        return
    same(catalog.queries()[name](spark, SF), con, catalog.oracle_sql()[name])


def test_entry_point(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
