"""Every named query against its SQL, on the smallest tables."""

import os

import oracle
import pytest

import __spark_entry__ as contract

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def db():
    return oracle.connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(contract.queries()))
def test_query_matches_sql(spark, db, name):
    df = contract.queries()[name](spark, SF_DIR)
    sql = contract.oracle_sql().get(name)
    if sql is None:
        assert df.columns
        df.collect()
    else:
        assert oracle.difference(df, db, sql) is None


def test_entry_has_the_flagship_schema(spark):
    df = contract.entry(spark)
    assert df.columns[:4] == ["customer_id", "name", "email", "customer_source"]
    assert df.count() > 0
