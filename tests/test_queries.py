"""Each query against its SQL, on the smallest dataset."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as entry  # noqa: E402
from check_oracles import connect, differences  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def connection():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query(spark, connection, name):
    assert differences(spark, connection, FOLDER, name, entry.queries()[name], SQL[name]) == ""


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_all_queries_of_the_package_have_sql():
    from paralane.plans.queries import QUERIES

    assert set(QUERIES) <= set(SQL) <= set(entry.queries())
