"""Registered queries with a DuckDB twin, and that all are registered."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry
from compare import duck, mismatch
from oreline.llm.sql import oracle_sql

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_matches_its_twin(spark, con, name):
    assert mismatch(entry.queries()[name](spark, SF_DIR), con, oracle_sql()[name]) is None


def test_every_operator_is_registered():
    names = {n.split("_")[0] for n in entry.queries()}
    assert {f"op{n}" for n in range(1, 14)} | {"pipeline"} <= names
