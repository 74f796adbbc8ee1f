"""Every registered query against its SQL, row by row, on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
import checks
from compare import connect, difference

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_every_query_has_sql():
    assert set(checks.all_queries()) == set(checks.all_sql())


@pytest.mark.parametrize("name", sorted(checks.all_queries()))
def test_query(spark, con, name):
    bad, (ours, theirs, _, _) = difference(spark, con, entry.queries()[name], entry.oracle_sql()[name], FOLDER)
    assert bad is None
    assert ours == theirs > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0
