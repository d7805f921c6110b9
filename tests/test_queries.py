"""Every registered query against its SQL twin on the smallest data set."""

import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_points

FOLDER = "/root/testdata/sf0.001"
QUERIES, ORACLE = entry_points.queries(), entry_points.oracle_sql()


@pytest.fixture(scope="module")
def tables():
    if not Path(FOLDER).exists():
        pytest.skip("no test data")
    connection = duckdb.connect()
    for file in Path(FOLDER).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def canonical(columns, rows):
    def cell(value):
        if value is None or (isinstance(value, float) and math.isnan(value)):
            return ""
        return f"{value + 0.0:.6f}" if isinstance(value, float) else str(value)

    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(cell(row[i]) for i in order) for row in rows)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, tables, name):
    frame = QUERIES[name](spark, FOLDER)
    rows = [tuple(r) for r in frame.collect()]
    assert rows
    if name in ORACLE:
        twin = tables.sql(ORACLE[name])
        assert canonical(frame.columns, rows) == canonical(twin.columns, twin.fetchall())


def test_entry_has_rows(spark):
    assert entry_points.entry(spark).limit(1).count() == 1


def test_oracle_names_are_queries():
    assert set(ORACLE) <= set(QUERIES)
