"""Every query of the catalog against its SQL on the smallest tables; all of them have one."""

import check
import pytest

import __spark_entry__ as entry
from fieldsieve import catalog

QUERIES = catalog.all_queries()


@pytest.fixture(scope="module")
def duck(small):
    return check.connect(small)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, small, duck, name):
    assert check.compare(QUERIES[name].run(spark, small), duck, QUERIES[name].sql) is None


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    registered, sql = entry.queries(), entry.oracle_sql()
    assert set(QUERIES) <= set(registered) and set(sql) <= set(registered)
