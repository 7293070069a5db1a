"""Every registered query against its SQL twin in DuckDB, at the smallest scale."""

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tools"))

import __spark_entry__ as entrypoint  # noqa: E402
from check_oracle import compare, connect, rows_of  # noqa: E402

QUERIES = entrypoint.queries()
SQL = entrypoint.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


def test_every_sql_has_a_query():
    assert not SQL.keys() - QUERIES.keys()


def test_entry_gives_rows(spark):
    assert entrypoint.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_as_sql(spark, sf_dir, duck, name):
    frame = QUERIES[name](spark, sf_dir)
    cursor = duck.execute(SQL[name])
    columns = [item[0] for item in cursor.description]
    assert sorted(columns) == sorted(frame.columns)
    mine = rows_of(frame.columns, [tuple(row) for row in frame.collect()])
    assert compare(mine, rows_of(columns, cursor.fetchall())) is None
