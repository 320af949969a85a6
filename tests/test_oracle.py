"""Every registered query against its expected SQL result."""

import os

import pytest

import __spark_entry__ as entry
from compare import differences, duck

SF_DIR = os.environ.get("CARDLAKE_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def connection():
    return duck(SF_DIR)


@pytest.mark.parametrize("key", sorted(entry.QUERIES))
def test_query_equals_expected(spark, connection, key):
    df = entry.queries()[key](spark, SF_DIR)
    assert differences(df, connection, entry.oracle_sql()[key]) == ""


def test_entry(spark):
    assert entry.entry(spark).count() == 10


def test_every_query_has_an_expected_result():
    assert set(entry.QUERIES) <= set(entry.oracle_sql())
