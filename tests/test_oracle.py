"""Every named query against its SQL, and the shape of the entry module."""

import pytest

import __spark_entry__ as entry
from archivekit.plans.oracles import ORACLES
from archivekit.plans.queries import QUERIES
from compare import connect, difference

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_names_match():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    assert difference(entry.queries()[name](spark, FOLDER), entry.oracle_sql()[name], con) is None


def test_entry(spark):
    df = entry.entry(spark)
    assert "near_complete" in df.columns and df.count() > 0
