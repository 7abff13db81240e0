"""Every registered query with SQL, compared with DuckDB on the smallest tables."""

import pytest

import __spark_entry__ as entry
import check

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return check.oracle(FOLDER)


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_sql(spark, con, name):
    df = entry.queries()[name](spark, FOLDER)
    assert check.compare(df, con, entry.oracle_sql()[name]) == ""


def test_flagship(spark):
    df = entry.entry(spark)
    assert len(df.columns) == 16 and df.columns[-1] == "price"
    assert df.count() == 2844
