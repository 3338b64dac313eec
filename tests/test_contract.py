import pytest
from conftest import SMALL

import __spark_entry__ as contract
from compare import difference, oracle

from docweave.plans import oracles, testbed

SQL = oracles.SQL


def test_keys():
    assert set(contract.oracle_sql()) <= set(contract.queries()) and set(testbed.QUERIES) <= set(contract.queries())
    assert set(testbed.QUERIES) == set(SQL)


def test_entry(spark):
    assert contract.entry(spark).count() > 0


@pytest.mark.parametrize("name", list(testbed.QUERIES))
def test_query_equals_its_sql(spark, name):
    rows = contract.queries()[name](spark, SMALL).toArrow()
    if name in SQL:
        assert difference(rows, oracle(SMALL, SQL[name])) is None
    else:
        assert len(rows) > 0
