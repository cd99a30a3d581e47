"""Main text of web pages, with suffix arrays over the token streams of each host.

A page is cut into blocks. Elements that HTML itself sets apart (menus, footers,
asides, forms, hidden parts), and block elements whose whole class name or id says
so, are left out; if the page marks an article or main part, its text is that part.
End tags that HTML lets a page omit are supplied, inline elements never cut a block,
and no name counts against an element that holds the article.

What tags do not decide, the other pages of the host do. The blocks of a page without
a marked article are its token stream. Pages of a host are dealt into shards of about
``SHARD_TOKENS`` (of about ``SHARD_PAGES`` where pages are longer); each shard's streams are put into one suffix array (built by linear
grouping) that proposes the strings of ``REPEAT_TOKENS`` tokens common in it. Proposed
strings and whole blocks are counted over the host; those that stand on
``COMMON_PERCENT`` of its distinct pages are boilerplate. A block that they
cover goes, all others stay whole. Inside marked articles a whole block goes if it
stands in ``ARTICLES`` different articles of the host or more, and in
``ARTICLE_PERCENT`` of them.

Pages that have most of their tokens in blocks of other pages count as one if their
longest such block is the same, so copies of an unmarked article are not taken for
boilerplate; marked articles are one if their text is.

Pages are parsed twice: once for the streams, once for the text. Nothing but token and
block hashes is stored or moved in between; the pages move only if the list of blocks
to drop is too long for Spark to broadcast.

Cases: null and empty pages have an empty text; a null url is a host of its own;
repeated rows are one page to the arrays; null and repeated ids are told apart by a
hash of the html; unclosed and stray tags are tolerated. Every input row gives one
output row; columns named like a result are replaced, others stay. An empty table
gives an empty result.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from html.parser import HTMLParser

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from oreline.llm.common import kept, meet_totals, require, scratch, stored
from oreline.llm.suffix_dedup import suffix_array

REPEAT_TOKENS = 8
COVERED_PERCENT = 90  # of a block's tokens
COMMON_PERCENT = 50  # of the distinct pages of a host
SHARD_TOKENS = 1 << 15
SHARD_PAGES = 64
ARTICLES = 8
ARTICLE_PERCENT = 80
MAIN, OPEN, OUTSIDE = "main", "open", "outside"
BEGIN, END = -1, -2  # of a block, beside the hashes of its tokens

# Elements by what they do to the text around them.
SILENT = set("script style noscript template iframe svg canvas object title button select textarea".split())
EXCLUDED = set("nav footer aside menu dialog".split())
BLOCKS = set(
    "html body div section article main header form fieldset table thead tbody tfoot tr ul ol dl li "
    "dt dd p h1 h2 h3 h4 h5 h6 blockquote pre figure figcaption caption address details summary "
    "center nav footer aside menu dialog".split()
)
GAPS = set("br td th img".split())
VOID = set("area base br col embed hr img input link meta source track wbr".split())
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
# Elements that a start tag ends where HTML lets their end tag be left out, and what
# keeps it from looking further up.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "caption"}, {"table"}),
    "thead": ({"tr", "thead", "tbody", "caption"}, {"table"}),
    "tbody": ({"tr", "thead", "tbody", "caption"}, {"table"}),
    "tfoot": ({"tr", "thead", "tbody", "caption"}, {"table"}),
}
# Elements that no name counts against.
TRUSTED = set("html body main article".split())
OUT_NAMES = set(
    "ad ads advert advertisement adsense ad-slot banner promo promotion sponsor sponsored cookie "
    "cookies cookie-banner cookie-notice cookie-consent consent gdpr notice alert popup modal overlay "
    "newsletter subscribe subscription signup sidebar widget menu nav navbar navigation breadcrumb "
    "breadcrumbs footer site-footer masthead topbar site-header comment comments comment-list "
    "disqus_thread replies respond share sharing social social-share related related-posts recommended "
    "pagination pager toolbar login search search-form skip-link".split()
)
COMMENT_NAMES = set("comment comments comment-list disqus_thread replies respond".split())
OUT_ROLES = set("navigation banner contentinfo complementary search form dialog alert menu".split())
MAIN_NAMES = set(
    "article article-body article-content post post-body post-content entry entry-content story "
    "story-body content main-content".split()
)


@dataclass
class _Element:
    tag: str
    # Left out for what it is, for what it is called, or as a form.
    out: str | None = None
    main: bool = False
    comments: bool = False
    within: list[_Element] = field(default_factory=list)


class _Blocks(HTMLParser):
    """Collects the blocks of a page with the elements they stand in."""

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.found: list[tuple[list[_Element], str]] = []
        self.open: list[_Element] = []
        self.mains: list[_Element] = []
        self.parts: list[str] = []
        self.silent, self.depth = "", 0
        # An element that is never closed silences nothing.
        closings = re.findall(r"</(noscript|template|iframe|svg|canvas|object|title|button|select|textarea)\b", html, re.I)
        self.closings = Counter(c.lower() for c in closings)

    def _flush(self) -> None:
        text = " ".join("".join(self.parts).split())
        self.parts.clear()
        if text:
            self.found.append((list(self.open), text))

    def _end(self, tags: set[str], stop: set[str]) -> None:
        """End the nearest open element of ``tags`` below the nearest of ``stop``."""
        for k in range(len(self.open) - 1, -1, -1):
            if self.open[k].tag in stop:
                return
            if self.open[k].tag in tags:
                self._flush()
                del self.open[k:]
                return

    def handle_starttag(self, tag, attrs):
        if self.silent:
            self.depth += tag == self.silent
            return
        if tag in SILENT:
            if tag in ("script", "style") or self.closings[tag]:
                self.silent, self.depth = tag, 1
            return
        if tag in GAPS:
            self.parts.append(" ")
            return
        if tag == "hr":
            self._flush()
        if tag not in BLOCKS:
            return
        if self.open and self.open[-1].tag == "p":
            self._end({"p"}, set())
        if tag in HEADINGS and self.open and self.open[-1].tag in HEADINGS:
            self._end(HEADINGS, set())
        while tag in ENDS:
            before = len(self.open)
            self._end(*ENDS[tag])
            if len(self.open) == before:
                break
        self._flush()
        self.open.append(self._element(tag, dict(attrs)))

    def _element(self, tag: str, named: dict[str, str | None]) -> _Element:
        names = {x.lower() for x in f"{named.get('class') or ''} {named.get('id') or ''}".split()}
        role = (named.get("role") or "").lower()
        apart = any(e.out == "tag" for e in self.open)
        inside = any(e.main for e in self.open)
        new = _Element(tag, comments=bool(names & COMMENT_NAMES), within=list(self.open))
        if tag in TRUSTED:
            pass
        elif tag in EXCLUDED or "hidden" in named or (tag == "header" and not inside):
            new.out = "tag"
        elif role in OUT_ROLES or names & OUT_NAMES:
            new.out = "name"
        elif tag == "form":
            new.out = "form"
        marked = tag in ("article", "main") or role in ("main", "article")
        marked = marked or (tag in ("div", "section") and bool(names & MAIN_NAMES))
        if marked and not apart and not new.out:
            new.main = True
            self.mains.append(new)
        return new

    def handle_startendtag(self, tag, attrs):
        if tag in GAPS:
            self.parts.append(" ")
        elif (tag in BLOCKS or tag == "hr") and not self.silent:
            self._flush()

    def handle_endtag(self, tag):
        self.closings[tag] -= tag in self.closings
        if self.silent:
            self.depth -= tag == self.silent
            if not self.depth:
                self.silent = ""
            return
        if tag in BLOCKS:
            # A stray end tag does not end an article that it stands in.
            self._end({tag}, {"article", "main"} - {tag})
            self._flush()

    def handle_data(self, data):
        if not self.silent:
            self.parts.append(data)

    def zones(self) -> list[tuple[str, str]]:
        """(zone, text) of each block, now that the whole page is known."""
        self._flush()
        free = [e for e in self.mains if not any(x.out and x.comments for x in e.within)]
        whole = sum(len(text) for at, text in self.found if not any(e.out == "tag" for e in at))
        doubted = {id(e): e for at, _ in self.found for e in at if e.out in ("name", "form")}
        for e in doubted.values():
            holds = [m for m in free if any(x is e for x in m.within)]
            if free:
                trusted = len(holds) == len(free)
            else:
                size = sum(len(text) for at, text in self.found if any(x is e for x in at))
                trusted = 2 * size > whole and not e.comments
            if trusted:  # it holds the article, so it is no menu, notice or form
                e.out = None
        out = []
        for at, text in self.found:
            if any(e.out for e in at):
                out.append((OUTSIDE, text))
            else:
                out.append((MAIN if any(e.main for e in at) else OPEN, text))
        return out


def blocks(html: str | None) -> list[tuple[str, str]]:
    """(zone, text) of each block in page order."""
    parser = _Blocks(html or "")
    parser.feed(html or "")
    parser.close()
    return parser.zones()


def candidates(html: str | None) -> tuple[bool, list[str]]:
    """Whether the page marks an article, and the blocks that may be its text."""
    found = blocks(html)
    main = [text for zone, text in found if zone == MAIN]
    return (True, main) if main else (False, [text for zone, text in found if zone == OPEN])


def _bytes(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def _host(url: str) -> F.Column:
    return F.lower(F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"^[a-zA-Z][\w+.-]*://([^/?#]*)", 1))


def _mark(html: str) -> F.Column:
    """Tells pages of one id apart."""
    return F.xxhash64(F.coalesce(F.col(html), F.lit("")))


def streams(pages: DataFrame, html: str, url: str, page_id: str) -> DataFrame:
    """``(host, page_id, mark, article, seq, block, n, tokens)`` of candidate blocks.

    ``article`` is the hash of a marked article's text and null without one; only
    blocks of pages without one have their ``tokens``, as hashes.
    """
    rows = pages.select(
        _host(url).alias("host"),
        # As text: pandas would round great ids beside nulls.
        F.col(page_id).cast("long").cast("string").alias("page_id"),
        _mark(html).alias("mark"),
        F.col(html).alias("html"),
    )

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            row, article, seq, block, n, tokens = [], [], [], [], [], []
            for k, body in enumerate(batch["html"]):
                marked, texts = candidates(body)
                whole = xxhash.xxh3_128_digest(_bytes("\n\n".join(texts))) if marked else None
                for i, text in enumerate(texts):
                    words = _bytes(text).split(b" ")
                    row.append(k)
                    article.append(whole)
                    seq.append(i)
                    block.append(xxhash.xxh3_128_digest(_bytes(text)))
                    n.append(len(words))
                    hashes = None if marked else [xxhash.xxh3_64_intdigest(w) >> 1 for w in words]
                    tokens.append(hashes)
            if not row:
                continue
            heads = batch[["host", "page_id", "mark"]].iloc[row]
            heads = heads.reset_index(drop=True)
            yield heads.assign(article=article, seq=seq, block=block, n=n, tokens=tokens)

    schema = (
        "host string, page_id string, mark long, article binary, seq int, block binary, n long, tokens array<long>"
    )
    return rows.mapInPandas(cut, schema)


def common_in_articles(rows: DataFrame) -> DataFrame:
    """``(page_id, mark, seq)`` of blocks that stand in most articles of their host."""
    rows = rows.where("article is not null")
    held = rows.select("host", "block", "article").distinct()
    seen = held.groupBy("host", "block").agg(F.count(F.lit(1)).alias("seen"))
    seen = seen.where(F.col("seen") >= ARTICLES)
    hosts = rows.select("host", "article").distinct().groupBy("host")
    hosts = hosts.agg(F.count(F.lit(1)).alias("of_host"))
    out = meet_totals(seen, hosts, "host")
    out = out.where(F.col("seen") * 100 >= F.col("of_host") * ARTICLE_PERCENT)
    out = stored(out.select("host", "block"), "in_articles")
    return meet_totals(rows, out, "host", "block").select("page_id", "mark", "seq")


def distinct_pages(rows: DataFrame) -> DataFrame:
    """``(host, page, one)``: pages that share most of their text have one name in common."""
    rows = rows.select("host", F.struct("page_id", "mark").alias("page"), "seq", "block", "n")
    pages = rows.select("host", "block", "page").distinct()
    known = pages.groupBy("host", "block").agg(F.count(F.lit(1)).alias("n_pages"))
    again = known.where("n_pages > 1").select("host", "block")
    shared = meet_totals(rows, again, "host", "block")
    total = rows.groupBy("host", "page").agg(F.sum("n").alias("n"))
    held = shared.groupBy("host", "page").agg(
        F.sum("n").alias("held"), F.max(F.struct("n", "block")).alias("longest")
    )
    held = held.withColumnsRenamed({"host": "in", "page": "of"})
    own = F.unhex(F.md5(F.to_json("page")))
    return total.join(held, F.expr("host = in and page <=> of"), "left").select(
        "host", "page", F.when(F.col("held") * 2 > F.col("n"), F.col("longest.block")).otherwise(own).alias("one")
    )


def array_strings(tokens: list[np.ndarray], ones: np.ndarray, least: int) -> np.ndarray:
    """Strings of ``REPEAT_TOKENS`` symbols that stand on ``least`` distinct pages, one a row.

    ``tokens`` are those of each block, ``ones`` the page each stands on. A string lies
    within a block, whose begin and end are symbols.
    """
    known = np.unique(np.concatenate(tokens))
    values = np.r_[BEGIN, END, known].astype(np.int64)
    codes = {t: k + 2 for k, t in enumerate(known.tolist())}
    text: list[int] = []
    stop = -2
    for block in tokens:
        # A stop of its own keeps strings inside a block.
        text += [0, *map(codes.__getitem__, block.tolist()), 1, stop]
        stop -= 1
    owner = np.repeat(np.arange(len(tokens)), [len(t) + 3 for t in tokens])
    order = np.array(suffix_array(text))
    symbols = np.array(text + [-1] * REPEAT_TOKENS)
    one, two = order[:-1], order[1:]
    same = np.ones(len(one), bool)
    for k in range(REPEAT_TOKENS):
        same &= symbols[one + k] == symbols[two + k]
    # Intervals of suffixes with a common prefix, and the distinct pages of each.
    interval = np.r_[0, np.cumsum(~same)]
    pairs = np.unique(np.stack([interval, ones[owner[order]]]), axis=1)
    first = order[np.flatnonzero(np.r_[True, ~same])]
    first = first[np.bincount(pairs[0]) >= least]
    strings = symbols[first[:, None] + np.arange(REPEAT_TOKENS)]
    return values[strings[(strings >= 0).all(axis=1)]]


def _proposed(dealt: DataFrame) -> DataFrame:
    """``(host, string)`` of the strings that the suffix array of a shard finds common there.

    A distinct page that lies in several shards counts in full where a string is held and
    in part where pages are counted. So the counts of all shards add up to no less than the
    host's, their pages to just the host's, and a string that is common on the host is
    common in one of its shards at least.
    """
    parts = dealt.select("host", "shard", "one").distinct()
    times = parts.groupBy("host", "one").agg(F.count(F.lit(1)).alias("times"))
    share = meet_totals(parts, times, "host", "one").groupBy("host", "shard")
    share = share.agg(F.sum(F.lit(1.0) / F.col("times")).alias("share"))
    rows = meet_totals(dealt.select("host", "shard", "one", "tokens"), share, "host", "shard")

    def propose(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        ones = pd.factorize(group["one"].map(bytes))[0]
        # Rounding must not raise it.
        least = max(1, int(np.ceil(COMMON_PERCENT * group["share"].iloc[0] / 100 - 1e-6)))
        strings = array_strings([np.asarray(t) for t in group["tokens"]], ones, least)
        return pd.DataFrame({"host": key[0], "symbols": pd.Series(list(strings), dtype=object)})

    found = rows.groupBy("host", "shard").applyInPandas(propose, "host string, symbols array<long>")
    return found.select("host", F.xxhash64("symbols").alias("string")).distinct()


def common_in_streams(rows: DataFrame) -> DataFrame:
    """``(page_id, mark, seq)`` of blocks that strings common on their host cover.

    The suffix arrays of the host's shards propose strings; what they propose is counted
    over the whole host, so how its pages are dealt decides nothing.
    """
    # Repeated rows are one page.
    rows = rows.where("article is null").dropDuplicates(["host", "page_id", "mark", "seq"])
    rows = stored(rows.drop("article"), "streams")
    named = distinct_pages(rows).toDF("of_host", "of_page", "one")
    sizes = rows.groupBy("host", "page_id", "mark").agg(F.sum("n").alias("n")).groupBy("host")
    # A shard needs pages to compare, however long they are.
    room = sizes.agg(
        F.least(
            F.ceil(F.sum("n") / SHARD_TOKENS), F.ceil(F.count(F.lit(1)) / SHARD_PAGES)
        ).cast("long").alias("shards")
    )
    dealt = meet_totals(rows, room, "host")
    dealt = dealt.join(named, F.expr("host = of_host and struct(page_id, mark) <=> of_page"))
    shard = F.expr("pmod(xxhash64(page_id, mark), shards)").alias("shard")
    dealt = stored(dealt.select("host", shard, "page_id", "mark", "seq", "block", "n", "one", "tokens"), "dealt")
    hosts = dealt.select("host", "one").distinct().groupBy("host").agg(F.count(F.lit(1)).alias("of_host"))

    def common(held: DataFrame, what: str) -> DataFrame:
        seen = held.select("host", what, "one").distinct().groupBy("host", what)
        seen = meet_totals(seen.agg(F.count(F.lit(1)).alias("seen")).where("seen > 1"), hosts, "host")
        return seen.where(F.col("seen") * 100 >= F.col("of_host") * COMMON_PERCENT).select("host", what)

    # Whole blocks, of any length.
    equal = meet_totals(dealt, common(dealt, "block"), "host", "block").select("page_id", "mark", "seq")

    symbols = F.concat(F.array(F.lit(BEGIN)), "tokens", F.array(F.lit(END)))
    last = F.col("n").cast("int") + 2 - REPEAT_TOKENS
    strings = F.transform(
        F.sequence(F.lit(0), last), lambda at: F.xxhash64(F.slice(symbols, at + 1, REPEAT_TOKENS))
    )
    held = dealt.where(last >= 0).select(
        "host", "page_id", "mark", "seq", "n", "one", F.posexplode(strings).alias("at", "string")
    )
    held = stored(meet_totals(held, _proposed(dealt), "host", "string"), "held")
    held = meet_totals(held, common(held, "string"), "host", "string")
    places = held.groupBy("host", "page_id", "mark", "seq", "n").agg(
        F.sort_array(F.collect_set("at")).alias("places")
    )
    # Symbols that the strings cover, less the begin and the end.
    covered = F.expr(
        "aggregate(sequence(1, size(places)), 0, (sum, k) -> sum + "
        f"if(k = size(places), {REPEAT_TOKENS}, least({REPEAT_TOKENS}, places[k] - places[k - 1])))"
    )
    for edge in (F.lit(0), last):
        covered = covered - F.array_contains("places", edge).cast("int")
    places = places.where(covered * 100 >= COVERED_PERCENT * F.col("n"))
    return equal.union(places.select("page_id", "mark", "seq"))


def extract(
    pages: DataFrame, html: str = "html", url: str = "url", page_id: str = "page_id"
) -> DataFrame:
    """``pages`` without the html, with ``text``, ``n_chars`` and ``n_boilerplate``, the
    number of its blocks that other pages of the host gave away.
    """
    require(pages, html, url, page_id)
    added = ["text", "n_chars", "n_boilerplate"]
    columns = [c for c in pages.columns if c != html and (c not in added or c in (url, page_id))]
    with scratch(pages.sparkSession):
        rows = stored(streams(pages, html, url, page_id), "blocks")
        gone = common_in_articles(rows).union(common_in_streams(rows))
        gone = gone.groupBy("page_id", "mark").agg(F.collect_set("seq").alias("gone"))
        gone = kept(gone.toDF("of", "with", "gone"), "boilerplate")
    own = F.struct(*[F.col(f"`{c}`") for c in columns]).alias("own")
    keyed = pages.select(
        own, F.col(page_id).cast("long").cast("string").alias("key"), _mark(html).alias("mark"), F.col(html).alias("html")
    )
    both = keyed.join(gone, F.expr("key <=> of and mark = with"), "left").select("own", "html", "gone")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, counts = [], []
            for body, drop in zip(batch.column("html").to_pylist(), batch.column("gone").to_pylist()):
                drop = set(drop or ())
                left = [text for k, text in enumerate(candidates(body)[1]) if k not in drop]
                texts.append("\n\n".join(left))
                counts.append(len(drop))
            columns = [pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64()), pa.array(counts, pa.int64())]
            yield pa.RecordBatch.from_arrays([batch.column("own"), *columns], names=["own", *added])

    kinds = (StringType(), LongType(), LongType())
    new = [StructField(c, kind) for c, kind in zip(added, kinds)]
    out = both.mapInArrow(write, StructType([keyed.schema["own"], *new]))
    return out.select(*[F.col(f"own.`{c}`") for c in columns], *added)
