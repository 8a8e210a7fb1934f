"""Every registered query against its SQL, values compared exactly."""

from __future__ import annotations

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry_point
from zoneflow.plans.oracle import ORACLE
from zoneflow.plans.queries import QUERIES
from conftest import SF_DIR

TABLES = sorted(name[:-8] for name in os.listdir(SF_DIR) if name.endswith(".parquet"))


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return connection


def plain(value):
    if isinstance(value, float) and math.isnan(value):
        return None
    return tuple(plain(v) for v in value) if isinstance(value, (list, tuple)) else value


def rows(names, records):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(plain(record[i]) for i in order) for record in records), key=repr)


def test_every_query_has_sql():
    assert set(QUERIES) <= set(entry_point.queries())
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_result(spark, duck, name):
    got = entry_point.queries()[name](spark, SF_DIR)
    want = duck.execute(entry_point.oracle_sql()[name])
    names = [column[0] for column in want.description]
    assert sorted(got.columns) == sorted(names)
    expected = rows(names, want.fetchall())
    actual = rows(got.columns, [tuple(row) for row in got.collect()])
    assert len(actual) == len(expected)
    differing = [(a, e) for a, e in zip(actual, expected) if a != e]
    assert not differing, differing[:3]
    assert expected or name in ("pattern_violations",)


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0
