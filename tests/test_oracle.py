"""Every registered query against its SQL, on the smallest tables."""

import pytest
from compare import connect, differences
from conftest import SF_DIR

import __spark_entry__ as entry
from closepass.plans.catalog import QUERIES
from closepass.plans.oracle import ORACLE


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() == 20


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, con, name):
    result = entry.queries()[name](spark, SF_DIR)
    assert differences(result, con, entry.oracle_sql()[name]) is None
