import pytest

import compare
from checks.oracle import oracle_sql
from checks.queries import queries

SF = "/root/testdata/sf0.001"
SQL, QUERIES = oracle_sql(), queries()


@pytest.fixture(scope="module")
def con():
    return compare.connect(SF)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_its_sql(spark, con, name):
    assert compare.difference(spark, con, QUERIES[name], SQL[name], SF) is None


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
