"""Every registered query against its SQL twin on the smallest tables."""

import pytest

import check
from sparkaudit import plans

FOLDER = "/root/testdata/sf0.001"
SQL = plans.oracle_sql()
NO_SQL = sorted(set(plans.queries()) - set(SQL))


@pytest.fixture(scope="module")
def duck():
    return check.connect(FOLDER)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows(spark, duck, name):
    assert check.compare(plans.queries()[name](spark, FOLDER), duck, SQL[name]) == ""


@pytest.mark.parametrize("name", NO_SQL)
def test_runs(spark, name):
    df = plans.queries()[name](spark, FOLDER)
    assert df.count() > 0
    assert len(set(df.columns)) == len(df.columns)


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
