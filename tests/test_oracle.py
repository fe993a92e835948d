"""Each registered query against its SQL, on whole tables."""

import os

import pytest

import __spark_entry__ as contract
from compare import connect, spark_rows, sql_rows

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def connection():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_query_matches_sql(spark, connection, name):
    columns, rows = spark_rows(contract.queries()[name](spark, SF_DIR))
    expected_columns, expected = sql_rows(connection, contract.oracle_sql()[name])
    assert columns == expected_columns
    assert rows, "the query should give rows on the test tables"
    missing, extra = expected - rows, rows - expected
    assert not missing and not extra, (
        f"{len(rows)} rows, {len(missing)} missing {list(missing)[:3]}, "
        f"{len(extra)} extra {list(extra)[:3]}"
    )


def test_entry_runs(spark):
    assert contract.entry(spark).count() > 0


def test_all_sql_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())
