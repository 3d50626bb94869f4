"""Every registered query against its SQL counterpart on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
from compare import connect, differences

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, ORACLE = entry.queries(), entry.oracle_sql()
# On the smallest tables no minute or campaign happens to match.
MAY_BE_EMPTY: set[str] = set()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_sql_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns[0] == "user_id" and df.count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF)
    if name not in ORACLE:
        assert df.count() > 0
        return
    diff = differences(df, con, ORACLE[name])
    if name in MAY_BE_EMPTY:
        diff = [d for d in diff if d != "no rows"]
    assert not diff, diff
