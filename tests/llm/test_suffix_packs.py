"""Packs of anchors: their bound changes nothing, and a span is decided across packs."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from oreline.llm import suffix_dedup


@pytest.fixture(scope="module")
def quoting(spark):
    quote = " ".join(f"word{k} of the passage" for k in range(40))
    rows = [(i, f"{i} begins here {i * 7919} {quote} and {i} ends {i * 104729}") for i in range(40)]
    rows += [(100, "nothing else"), (None, rows[0][1]), (3, rows[3][1]), (101, None)]
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(5)


def _rows(docs):
    out = suffix_dedup.remove_repeats(docs)
    return sorted(map(tuple, out.collect()), key=str)


def test_packs_of_any_size_give_the_same(quoting, monkeypatch):
    want = _rows(quoting)
    assert sum(r[3] > 0 for r in want) == 42
    for rows in (1, 2, 7):
        monkeypatch.setattr(suffix_dedup, "PACK_ROWS", rows)
        assert _rows(quoting) == want


def test_packs_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "PACK_ROWS", 10)
    again = spark.range(1000).selectExpr(
        "1L as core", "2L as span", "false as mixed", "id as key", "id as mark", "0L as at", "0L as low", "9L as high"
    )
    packs = suffix_dedup._packed(again).selectExpr("size(places) as n").collect()
    assert sum(r.n for r in packs) == 1000 and max(r.n for r in packs) <= 10


def test_packs_that_lie_together_are_unpacked_evenly(spark):
    again = spark.range(0, 20000, 1, 1).selectExpr(
        "1L as core", "2L as span", "false as mixed", "id as key", "id as mark", "0L as at", "0L as low", "9L as high"
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        places = suffix_dedup._unpacked(suffix_dedup._packed(again).coalesce(1))
        tasks = places.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(r["count"] for r in tasks) == 20000
    assert len(tasks) == 8 and max(r["count"] for r in tasks) < 1.2 * 20000 / 8
