"""Pages that lost their article, and what the arrays of a host decide."""

from __future__ import annotations

import pytest

from oreline.llm import html_text

WORDS = " ".join(f"word{k}" for k in range(30))
PAGES = {
    "head without an end tag": f"<html><head><title>t</title><meta charset=x><body><article><p>{WORDS}</article>",
    "layout class on the body": f'<body class="single has-sidebar"><article><p>{WORDS}</article></body>',
    "out class on the body": f'<body class="sidebar nav"><article><p>{WORDS}</article></body>',
    "layout class on main": f'<main class="content no-sidebar"><p>{WORDS}</p></main>',
    "form around the page": f"<body><form id=aspnet><nav>m</nav><article><p>{WORDS}</p></article><input></form>",
    "form around an unmarked page": f"<body><form><p>{WORDS}</p></form><p>end</p>",
    "unclosed iframe": f"<article><p>{WORDS}</p><iframe src=x></article>",
    "unclosed iframe first": f"<iframe src=x><article><p>{WORDS}</article>",
    "unclosed noscript": f"<noscript><article><p>{WORDS}</article>",
    "out class around the article": f'<div class="widget"><article><p>{WORDS}</article></div>',
    "closed silent elements": f"<article><noscript>no</noscript><svg><title>s</title></svg><p>{WORDS}</p></article>",
    "comments as articles": f'<article><p>{WORDS}</article><section id="comments"><article>a comment</article></section>',
    "comments inside": f'<article><p>{WORDS}</p><div class="comments"><p>{WORDS} {WORDS}</div></article>',
    "stray ends": f"<div><article></div></nav></p><p>{WORDS}</p></article></div><footer>f</footer>",
    "article in an aside": f"<aside><article>teaser</article></aside><article>{WORDS}</article>",
}


@pytest.mark.parametrize("name", sorted(PAGES))
def test_the_article_stays(name):
    marked, found = html_text.candidates(PAGES[name])
    want = [WORDS, "end"] if "unmarked" in name else [WORDS]
    assert found == want


def test_blocks_end_where_html_says():
    text = lambda html: html_text.candidates(f"<article>{html}</article>")[1]
    assert text('<p class="notice">Buy now<p>real text') == ["real text"]
    assert text('<h2 class="alert-title">Storm alert</h2><p>x') == ["Storm alert", "x"]
    assert text('<p>one <a class="share">two</a> <span class="ad">three</span> <b id="search">four</b> five') == [
        "one two three four five"
    ]
    assert text("<ul><li>a<li>b<ul><li>c</ul><li class=ad>d<li>e</ul>") == ["a", "b", "c", "e"]
    assert text("<dl><dt>a<dd class=notice>b<dt>c</dl>") == ["a", "c"]
    assert text("<table><tr class=ad><td>x<td>y<tr><td>a<td>b</table>t") == ["a b", "t"]
    assert text("a<br>b<wbr>c<hr>d") == ["a bc", "d"]
    assert text("<h1>a<h2>b</h2>c") == ["a", "b", "c"]
    assert text("<header><h1>T</h1></header><p>x &amp;lt; &eacute;&nbsp; y") == ["T", "x &lt; é y"]
    assert text("x<button>b</button>y <select><option>o</select>z") == ["xy z"]


def _rows(spark, html, **more):
    rows = [(k, "http://h/x", h) for k, h in enumerate(html)]
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def words(name, n):
    return " ".join(f"{name}{k}" for k in range(n))


@pytest.mark.parametrize("shard", [1 << 15, 500])
def test_arrays_find_boilerplate_with_a_changing_part(spark, monkeypatch, shard):
    monkeypatch.setattr(html_text, "SHARD_TOKENS", shard)
    monkeypatch.setattr(html_text, "SHARD_PAGES", 8)
    quote = words("q", 12)
    own = [words(f"p{k}x", 25) + (f" {quote} and on" if k < 2 else "") for k in range(24)]
    html = [f"<div>{o}</div><div>{words('f', 20)} page {k} {words('g', 20)}</div><div>Menu</div>" for k, o in enumerate(own)]
    got = {r.page_id: (r.text, r.n_boilerplate) for r in html_text.extract(_rows(spark, html)).collect()}
    assert got == {k: (o, 2) for k, o in enumerate(own)}


def test_blocks_of_most_articles_go(spark):
    own = [words(f"p{k}x", 25) for k in range(12)]
    notice, often = "Read this in our app.", "A heading of some articles"
    html = [
        f"<article><h1>{o}</h1><p>{notice}</p>{f'<p>{often}</p>' if k < 6 else ''}<p>{o} more</p></article>"
        for k, o in enumerate(own)
    ]
    html += [html[0]] * 3  # copies of an article are one
    rows = _rows(spark, html)
    got = {r.page_id: r.text.split("\n\n") for r in html_text.extract(rows).collect()}
    want = {k: [o, *([often] if k < 6 else []), f"{o} more"] for k, o in enumerate(own)}
    assert got == want | {12 + k: want[0] for k in range(3)}
    few = html_text.extract(rows.where("page_id < 7")).collect()
    assert all(notice in r.text for r in few)


def test_all_copies_of_one_article_keep_it(spark):
    html = [f"<article><p>{WORDS}</p><p>second</p></article><!-- {k} -->" for k in range(40)]
    html += [f"<p>{WORDS} more</p><p>second one</p><!-- {k} -->" for k in range(40)]
    got = [r.text for r in html_text.extract(_rows(spark, html)).collect()]
    assert sorted(set(got)) == sorted([f"{WORDS}\n\nsecond", f"{WORDS} more\n\nsecond one"])


def test_columns_nulls_and_repeats(spark):
    names = ["own", "key", "mark", "html", "gone", "of", "with", "host", "text", "seq", "one", "block", "tokens"]
    rows = [(None, None, f"<p>{WORDS}"), (None, None, None), (2**60 + 1, "x", ""), (7, "http://h", "<article>a"), (7, "http://h", "<article>b")]
    frame = spark.createDataFrame(rows + rows[:1], "page_id long, url string, body string")
    for n in names:
        frame = frame.withColumn(n, frame.page_id)
    out = html_text.extract(frame, html="body")
    assert out.columns == ["page_id", "url", *[n for n in names if n != "text"], "text", "n_chars", "n_boilerplate"]
    got = sorted((str(r.page_id), str(r.own), r.text) for r in out.collect())
    none = "None"
    big = str(2**60 + 1)
    assert got == sorted([(none, none, WORDS)] * 2 + [(none, none, ""), (big, big, ""), ("7", "7", "a"), ("7", "7", "b")])
