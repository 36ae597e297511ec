import pytest

import __spark_entry__ as contract
from checks.compare import difference
from checks.queries import QUERIES

SF = "/root/testdata/sf0.001"


def test_contract(spark):
    assert contract.entry(spark).count() > 0
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", QUERIES)
def test_query_agrees_with_sql(spark, name):
    assert difference(spark, SF, name) is None
