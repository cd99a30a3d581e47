"""What is boilerplate is a host's matter, however its pages are dealt into shards."""

from __future__ import annotations

import pytest

from oreline.llm import html_text


@pytest.mark.parametrize("shard", [(1 << 15, 64), (60, 3), (1, 1)])
def test_shards_do_not_decide(spark, monkeypatch, shard):
    monkeypatch.setattr(html_text, "SHARD_TOKENS", shard[0])
    monkeypatch.setattr(html_text, "SHARD_PAGES", shard[1])
    words = lambda name, n: " ".join(f"{name}{k}" for k in range(n))
    page = lambda *parts: "".join(f"<div>{p}</div>" for p in parts)
    rows, want = [], {}
    for k in range(40):
        own = [words(f"p{k}x", 40), f"{words('half', 10)} {words(f'h{k}x', 10)}"]
        html = list(own)
        if k % 2 or k == 0:  # 21 of 40 pages: whole blocks, and blocks with a word of their own
            html += ["Imprint", f"{words('foot', 30)} by{k}"]
        else:
            own += ["References", f"{words('note', 30)} by{k}"]  # 19 of 40
            html += own[2:]
        rows.append((k, "http://h/x", page(*html)))
        want[k] = own
    article = [words("a", 30), words("b", 25)]
    for k in range(12):  # copies of an article are one page, in whatever shards
        rows.append((100 + k, "http://copies/x", page(*article, words(f"c{k}x", 5))))
        want[100 + k] = [*article, words(f"c{k}x", 5)]
    rows.append((200, "http://short/x", page("three words here")))  # proposes nothing
    want[200] = ["three words here"]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text.split("\n\n") for r in html_text.extract(frame).collect()}
    assert got == want
