"""Every registered query against its SQL, over the smallest driver tables."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry_points
from ranktide.plans.catalog import QUERIES
from check_oracle import compare, open_duckdb

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="driver tables are not here")


@pytest.fixture(scope="module")
def connection():
    return open_duckdb(FOLDER)


def test_every_query_of_the_star_schema_has_its_sql():
    assert set(QUERIES) <= set(entry_points.oracle_sql()) and set(QUERIES) <= set(entry_points.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, connection, name):
    equal, note = compare(spark, connection, FOLDER, name)
    assert equal, note


def test_entry(spark):
    assert entry_points.entry(spark).count() == 10
