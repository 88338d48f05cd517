"""Every registered query against its SQL, on the smallest tables."""

import pytest

import __spark_entry__ as entry
import check_sql

SF_DIR = entry.SMOKE_DIR


@pytest.fixture(scope="module")
def connection():
    return check_sql.connect(SF_DIR)


@pytest.mark.parametrize("name", entry.queries())
def test_query(spark, connection, name):
    rows, _ = check_sql.compare(spark, connection, name, SF_DIR)
    assert rows > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_checks_belong_to_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())
