import pytest

from cadencia.llm.queries import ORACLE_SQL, QUERIES
from checks.compare import difference

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ORACLE_SQL)
def test_query_agrees_with_sql(spark, name):
    assert difference(spark, SF, name) is None


def test_every_operator_has_a_query():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
