"""Every query against its SQL on the smallest data folder."""

import pytest

import __spark_entry__ as entry
from amperline.plans.catalog import QUERIES
from amperline.plans.oracle import ORACLE
from tests.compare import connect, difference

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, con, name):
    frame = entry.queries()[name](spark, FOLDER)
    assert difference(frame, con, entry.oracle_sql()[name]) is None


def test_same_names():
    assert set(QUERIES) == set(ORACLE) <= set(entry.queries())


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0
