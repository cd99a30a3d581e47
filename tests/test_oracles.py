"""Every registered query against its DuckDB twin."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry
import oracles
from compare import duck, mismatch
from oreline.plans import queries as registered

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
QUERIES, TWINS = registered.queries(), oracles.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(TWINS)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_its_twin(spark, con, name):
    assert mismatch(QUERIES[name](spark, SF_DIR), con, TWINS[name]) is None


def test_the_driver_sees_all_of_them():
    assert set(QUERIES) <= set(entry.queries())
    assert set(TWINS) <= set(entry.oracle_sql())


def test_flagship_returns_rows(spark):
    assert entry.entry(spark).count() > 0
