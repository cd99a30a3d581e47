"""Repeated windows that follow each other in a piece are one range."""

from __future__ import annotations

from oreline.llm import suffix_dedup


def test_runs_of_windows_are_one_range(spark):
    flank = bytes(range(24))
    odd = bytes([200, *range(1, 24)])  # only the first window, from the flank's begin, has its byte
    lone = bytes(range(100, 124))
    rows = [(1, 1, 500, flank, flank), (2, 2, 700, odd, flank), (3, 3, 900, lone, lone)]
    rows = [(key, mark, at, 7, 0, 24, 0, 24, left, right) for key, mark, at, left, right in rows]
    rows.append((None, 4, 300, 8, 0, 24, 0, 24, lone, flank))
    rows.append((5, 5, 300, 8, 0, 24, 3, 20, lone, flank))
    schema = (
        "key long, mark long, at long, core long, near long, far long, first long, last long, "
        "left binary, right binary"
    )
    pieces = spark.createDataFrame(rows, schema).coalesce(1).sortWithinPartitions("core")
    got = suffix_dedup._suffix_sorted(pieces, 400, 25).collect()
    want = [(1, 1, 477, 900), (2, 2, 677, 1100), (None, 4, 276, 700), (5, 5, 280, 697)]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
