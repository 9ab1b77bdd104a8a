"""Every query with SQL gives the rows of that SQL."""

import pytest
from oracle import SF, connect, differences

import __spark_entry__ as entry

SQL = {k: v for k, v in entry.oracle_sql().items() if "reckon.llm" not in entry.queries()[k].__module__}


@pytest.fixture(scope="module")
def con():
    return connect()


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, con, name):
    assert differences(entry.queries()[name](spark, SF), con, SQL[name]) == []
