"""Every turn of a conversation stands in the result with its own content."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from oreline.llm import chat
from oreline.llm.queries import REPLY_SCHEMA


@pytest.mark.parametrize("turn_range", [1024, 2])
def test_every_turn_has_a_row(spark, monkeypatch, turn_range):
    monkeypatch.setattr(chat, "TURN_RANGE", turn_range)
    turns = [
        (1, 0, "system", "be kind"),
        (1, 1, "assistant", "too early"),
        (1, 2, "user", "hello"),
        (1, 3, "assistant", "first"),
        (1, 7, "assistant", "second"),
        (1, 7, "assistant", "second"),
        (1, 9, "user", "more"),
        (2, 0, "user", "alone"),
        (2, 5, "tool", "odd"),
    ]
    frame = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    schemas = spark.sql(f"select * from {REPLY_SCHEMA} as t(tool, field, type, required)")
    got = chat.turn_rows(frame, schemas).collect()
    assert sorted((r.kind, r.call_id or "", r.turn or 0, r.status, r.level, r.content or "") for r in got if r.kind == "call") == [
        ("call", "call-1-2", 0, "linked", 0, ""),
        ("call", "call-1-9", 0, "unanswered", 1, ""),
        ("call", "call-2-0", 0, "unanswered", 0, ""),
    ]
    assert sorted((r.status, r.turn, r.call_id or "", r.content) for r in got if r.kind != "call") == [
        ("linked", 3, "call-1-2", "first"),
        ("orphan", 1, "call-1-1", "too early"),
        ("repeated", 7, "call-1-2", "second"),
        ("repeated", 7, "call-1-2", "second"),
        ("system", 0, "", "be kind"),
        ("tool", 5, "", "odd"),
    ]
    assert all(r.json for r in got)


def test_results_without_an_identifier_keep_their_content(spark):
    calls = spark.createDataFrame([], "call_id string, tool string, arguments string, depends_on array<string>")
    results = spark.createDataFrame([(None, 1, "a"), (None, 2, "b"), ("z", 1, "c"), ("z", 2, "d")], "call_id string, turn long, content string")
    schemas = spark.sql(f"select * from {REPLY_SCHEMA} as t(tool, field, type, required)")
    got = chat.link_rows(calls, results, schemas).collect()
    assert sorted((r.status, r.content) for r in got) == [("orphan", c) for c in "abcd"]


def test_the_query_has_as_many_rows_as_turns(spark):
    sf_dir = "/root/testdata/sf0.001"
    n = spark.read.parquet(f"{sf_dir}/conversations.parquet").count()
    assert entry.queries()["op3_chat_turns"](spark, sf_dir).count() == n
