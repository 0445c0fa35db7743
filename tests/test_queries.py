"""Every registered query against its SQL counterpart, on the small tables."""

import re

import pytest
from compare import check, connect

from ledgerloom.queries import ORACLES, QUERIES

ROWS_ONLY: set[str] = set()


@pytest.fixture(scope="module")
def con(data):
    return connect(data)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, data, con, name):
    df = QUERIES[name](spark, data)
    # The smallest tables end before the deep page.
    assert check(df, con, ORACLES[name], may_be_empty=name == "paginate_deep") is None
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search("CartesianProduct|BroadcastNestedLoopJoin", plan)


def test_every_query_has_sql_or_its_own_test():
    assert set(QUERIES) - set(ORACLES) == ROWS_ONLY
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())

