"""Pages without a marked article lose whole blocks of many pages, and nothing else."""

from __future__ import annotations

from oreline.llm import html_text


def test_unmarked_pages_lose_only_common_blocks(spark):
    words = lambda name, n: " ".join(f"{name}{k}" for k in range(n))
    footer, quote, heading = words("f", 12), words("q", 10), "References"
    page = lambda *parts: "".join(f"<div>{p}</div>" for p in parts)
    article = [words("a", 30), words("b", 25)]
    own = [words(f"p{k}x", 40) for k in range(8)]
    own[0], own[1] = f"{own[0]} {quote} end", f"start {quote} {own[1]}"
    html = [page(o, footer) for o in own]
    html[2], html[3] = page(own[2], heading, footer), page(own[3], heading, footer)
    html += [page(*article, words(f"ad{k}x", 5), footer) for k in range(6)]
    rows = [(k, "http://h/x", h) for k, h in enumerate(html)]
    rows += [(100 + k, "http://copies/x", page(*article, words(f"c{k}x", 5))) for k in range(3)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text.split("\n\n") for r in html_text.extract(frame).collect()}
    want = {k: [o] for k, o in enumerate(own)}
    want[2], want[3] = [own[2], heading], [own[3], heading]
    want |= {8 + k: [*article, words(f"ad{k}x", 5)] for k in range(6)}
    want |= {100 + k: [*article, words(f"c{k}x", 5)] for k in range(3)}
    assert got == want
