"""Every named query against DuckDB, or for rows where SQL cannot say it."""

import pytest

import __spark_entry__ as entry
from tests.oracle import compare, duck

CHECKED = "/root/testdata/sf0.01"
SMALL = "/root/testdata/sf0.001"
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def connections():
    return {folder: duck(folder) for folder in (CHECKED, SMALL)}


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, connections, name):
    folder = CHECKED if name in SQL else SMALL
    problem, remark, _, _ = compare(spark, connections[folder], name, folder)
    assert problem is None
    assert remark in ("", "rows only"), "values must agree to the last digit"


def test_entry_has_rows_and_columns(spark):
    df = entry.entry(spark)
    assert df.columns[:2] == ["window_start", "window_end"]
    assert df.limit(1).count() == 1


def test_every_oracle_has_a_query():
    assert set(SQL) <= set(entry.queries())
