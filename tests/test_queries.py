"""Every registered query against its SQL on the smallest data set."""

import pytest
from oracle import compare, connect

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_its_sql(spark, con, name):
    problem, _ = compare(spark, con, SF, entry.queries()[name], entry.oracle_sql()[name])
    assert problem is None


def test_names_and_rows_without_sql(spark):
    queries, oracle = entry.queries(), entry.oracle_sql()
    assert set(oracle) <= set(queries)
    for name in set(queries) - set(oracle):
        assert queries[name](spark, SF).count() > 0
    assert entry.entry(spark).count() > 0
