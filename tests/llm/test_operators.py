"""Operators against brute force, and their edge cases, on small tables."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from oreline.llm import (
    chat,
    html_text,
    line_rules,
    minhash,
    mixing,
    pieces,
    quality_classifier,
    sharding,
    suffix_dedup,
    vectors,
)
from oreline.llm.common import components, stored
from oreline.llm.queries import pieces_path

DOCS = "doc_id long, text string, lang string, source string, n_chars long, size string"


def _words(n, rng, stock=400):
    return " ".join(f"w{rng.randrange(stock)}" for _ in range(n))


def _texts():
    rng = random.Random(4)
    base, passage = _words(120, rng), _words(90, rng)
    near = base.split()
    near[60] = "changed"
    out = [base, base, " ".join(near), base.upper(), passage, None, "", " \t\n", "one", "two words"]
    out += [f"{_words(40, rng)} {passage} {_words(40, rng)}" for _ in range(6)]
    out += ["ab " * 400, "ab " * 400 + "x", "é" * 900, "q" * 401, _words(3000, rng), "same\nsame\nsame"]
    out += [_words(k, rng) for k in (3, 4, 5, 19, 20, 60)]
    return out


@pytest.fixture(scope="module")
def docs(spark):
    rows = [
        (k, t, "en", ["a", "b", None][k % 3], len(t or ""), "own") for k, t in enumerate(_texts())
    ]
    rows += [rows[4], (None, "a text without an id", None, None, None, None)]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def empty(docs):
    return docs.where("false")


def test_suffix_array():
    rng = random.Random(1)
    for _ in range(1500):
        n, k = rng.randint(0, 30), rng.choice([1, 2, 3])
        t = [rng.randrange(k) for _ in range(n)]
        assert suffix_dedup.suffix_array(t) == sorted(range(n), key=lambda i: t[i:])


@pytest.mark.parametrize("split", [128, 3, 1])
def test_repeats_are_those_of_brute_force(docs, monkeypatch, split):
    monkeypatch.setattr(suffix_dedup, "SPLIT_ABOVE", split)
    rows = docs.collect()
    data = [(r.text or "").encode() for r in rows]
    seen = Counter(b[i : i + 400] for b in data for i in range(len(b) - 399))
    want = Counter()
    for r, b in zip(rows, data):
        gone = np.zeros(len(b) + 1, bool)
        for i in range(len(b) - 399):
            if seen[b[i : i + 400]] > 1:
                gone[i : i + 400] = True
        kept = bytes(c for c, g in zip(b, gone) if not g)
        runs = int(np.count_nonzero(np.diff(np.r_[False, gone].astype(int)) == 1))
        want[(r.doc_id, len(b), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest())] += 1
    out = suffix_dedup.remove_repeats(docs)
    got = out.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()
    assert Counter(map(tuple, got)) == want
    assert any(k[2] for k in want)


def _sets(rows, width):
    out = []
    for r in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), r.text or ""))
        out.append({tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))} if w else set())
    return out


@pytest.mark.parametrize("width", [4, 5])
def test_near_duplicates_are_those_of_brute_force(docs, width):
    rows = docs.where("doc_id is not null").collect()
    sets = _sets(rows, width)
    name = {r.doc_id: r.doc_id for r in rows}
    for _ in rows:
        for a, s in zip(rows, sets):
            for b, t in zip(rows, sets):
                if s and 100 * len(s & t) >= 80 * len(s | t):
                    name[a.doc_id] = name[b.doc_id] = min(name[a.doc_id], name[b.doc_id])
    got = minhash.near_duplicates(docs, width=width).where("doc_id is not null").collect()
    assert len(got) == len(rows)
    assert {(r.doc_id, r.component_id) for r in got} == set(name.items())
    assert {(r.doc_id, r.n_shingles) for r in got} == {(r.doc_id, len(s)) for r, s in zip(rows, sets)}
    assert any(not r.kept for r in got)


def test_components(spark):
    edges = [(k, k + 1) for k in range(50)] + [(100, 101), (101, 100), (7, 7), (None, 3)]
    got = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {tuple(r) for r in got} == {(k, 0) for k in range(51)} | {(100, 100), (101, 100)}


def test_vectors_are_linked_as_by_brute_force(spark):
    rng = np.random.default_rng(3)
    centre = rng.normal(size=16)
    near = centre + rng.normal(size=(60, 16)) * 0.12
    v = [*near, *rng.normal(size=(80, 16)), *[near[0]] * 5]
    rows = [(k, [float(x) for x in row]) for k, row in enumerate(v)]
    bad = [None, [], [0.0] * 16, [None] + [1.0] * 15, [float("nan")] * 16, [float("inf")] * 16]
    rows += [(200 + k, b) for k, b in enumerate(bad)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    unit = np.array(v) / np.linalg.norm(v, axis=1, keepdims=True)
    linked = unit @ unit.T >= 0.95
    name = np.arange(len(v))
    for _ in v:
        name = np.array([name[row].min() for row in linked])
    got = {r.vec_id: (r.n_links, r.component_id) for r in vectors.near_vectors(frame).collect()}
    want = {k: (int(linked[k].sum()) - 1, int(name[k])) for k in range(len(v))}
    assert got == want | {k: (0, k) for k in range(200, 206)}


def test_line_rules_count_as_brute_force(docs):
    for r in line_rules.clean(docs).collect():
        t = r.text or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        seen = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
        inside = {j for i in range(len(w) - 7) if seen[tuple(w[i : i + 8])] > 1 for j in range(i, i + 8)}
        lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        want = (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)))
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines) == want
        assert r.n_repeat_words == len(inside)
        assert r.base_failed == (len(w) < 20 or 100 * len(inside) > 30 * len(w))
        assert not (r.kept and r.base_failed)


def test_lines_fail_by_their_rule(spark):
    good = " ".join(f"word{k}" for k in range(40)) + "."
    text = f"{good}\nHome | News | About\nMenu\nAll rights reserved.\nbuy*** now*** this*** $$$"
    (row,) = line_rules.clean(spark.createDataFrame([(text,)], "text string")).collect()
    assert (row.n_lines_removed, row.clean_text, row.kept) == (4, good, True)


def test_pieces_match_the_library(docs):
    model = pieces.load(pieces_path())
    for r in pieces.encode(docs, pieces_path()).collect():
        ids = [*model.encode(r.text or ""), model.eos_id()]
        assert (r.ids, r.n_tokens, r.decoded) == (" ".join(map(str, ids)), len(ids), model.decode(ids))


def test_mix_meets_its_targets(docs, spark):
    rows = [(k, " ".join(["w"] * (k % 90)), f"s{k % 4}" if k % 9 else None) for k in range(3000)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix(frame).toPandas()
    assert got.sort_values("doc_id").taken.tolist() == mixing.mix(frame).toPandas().sort_values("doc_id").taken.tolist()
    by = got.groupby(got.source.fillna("~")).agg({"taken": "sum", "target": "first", "source_size": "first"})
    assert (abs(by.taken - by.target) < 200).all() and (got.taken <= 3 * got["size"]).all()
    assert abs(by.target.sum() - got["size"].sum()) < 1e-6 * got["size"].sum()
    assert mixing.mix(docs).count() == docs.count()


def test_shards_fit(spark):
    rows = [(7, 1000)] * 300 + [(k, k % 700) for k in range(500)] + [(9001, 90000), (None, 5), (3, None)]
    frame = spark.createDataFrame(rows, "doc_id long, n_bytes long")
    got = sharding.assign_shards(frame, 20000).toPandas()
    assert len(got) == len(rows)
    by = got.groupby("shard_id").agg({"n_bytes": "sum", "doc_id": "size"})
    assert ((by.n_bytes <= 20000) | (by.doc_id == 1)).all()


def test_calls_are_linked_ordered_and_checked(spark):
    calls = [
        ("a", "reply", '{"turn": 1, "text":"x"}', []),
        ("b", "reply", '{"turn":"1","zz":2}', ["a"]),
        ("c", "nope", "{", ["b"]),
        ("d", "reply", "[1]", ["e"]),
        ("e", "reply", None, ["d", "q"]),
        (None, None, None, None),
    ]
    calls = spark.createDataFrame(calls, "call_id string, tool string, arguments string, depends_on array<string>")
    results = spark.createDataFrame([("a", 1, "r"), ("a", 0, "q"), ("z", 1, "o")], "call_id string, turn long, content string")
    schema = [("reply", "text", "string", True), ("reply", "turn", "integer", True)]
    schemas = spark.createDataFrame(schema, "tool string, field string, type string, required boolean")
    got = {r.call_id: r for r in chat.link_calls(calls, results, schemas).collect()}
    assert [got[k].level for k in "abcde"] == [0, 1, 2, None, None]
    assert got["a"].json == '{"arguments":{"text":"x","turn":1},"id":"a","level":0,"result":"q","tool":"reply"}'
    assert got["b"].errors == "missing text; type of turn; unknown zz"
    assert (got["z"].status, got["a"].n_results, got["c"].errors) == ("orphan", 2, "unknown tool")


def test_levels_are_longest_paths(spark):
    rng = random.Random(9)
    needs = {k: [k - 1] for k in range(1, 300)} | {0: []}  # one long chain
    for k in range(300, 500):
        needs[k] = rng.sample(range(k), rng.choice([0, 1, 1, 1, 2, 3]))
    want = {}
    for k in sorted(needs):
        want[k] = max((want[n] + 1 for n in needs[k]), default=0)
    needs |= {500: [502], 501: [500], 502: [501], 503: [500, 7], 504: [503], 505: [505], 506: [3, 505]}
    needs |= {507: [9999], 508: [9999, 299], 509: [299, 299]}
    want |= {k: None for k in range(500, 507)} | {507: 0, 508: want[299] + 1, 509: want[299] + 1}
    frame = spark.createDataFrame(
        [(str(k), [*map(str, v)]) for k, v in needs.items()], "call_id string, depends_on array<string>"
    )
    got = chat.levels(frame.union(frame.limit(3))).collect()
    assert len(got) == len(want) and {int(r.call_id): r.level for r in got} == want


def test_pages_keep_the_article(spark):
    footer = "<div>one two three four five six seven eight nine</div>"
    open_ = f"<body>{footer}<div>own words {{}} of this page that no other page of it has at all</div>"
    html = [
        "<nav>m</nav><article><h1>T &amp; u</h1><p>a<br>b <b>c</b><p>d</article><footer>f</footer>",
        open_.format(1),
        open_.format(2),
        None,
        "",
        "<div class='cookie-notice'>x</div><p>left <script>var a='</p>'</script>open",
    ]
    frame = spark.createDataFrame([(k, "http://h/x", h) for k, h in enumerate(html)], "page_id long, url string, html string")
    got = {r.page_id: r.text for r in html_text.extract(frame).collect()}
    assert got[0] == "T & u\n\na b c\n\nd"
    assert "one two" not in got[1] and "own words 1" in got[1]
    assert (got[3], got[4], got[5]) == ("", "", "left open")


def test_classifier_learns_and_scores_all(spark, docs):
    rng = random.Random(2)
    rows = [(k, _words(60, rng) + ("." if k % 2 else " *** $$$"), k % 2) for k in range(400)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, quality int")
    train = quality_classifier.training_rows(frame.drop("quality"), frame.drop("text"))
    got = quality_classifier.score(frame, quality_classifier.fit(train)).toPandas()
    assert ((got.score >= 0.7) == (got.quality == 1)).mean() > 0.97
    none = quality_classifier.fit(train.where("false"))
    assert quality_classifier.score(docs, none).where("score between 0 and 1").count() == docs.count()


def test_empty_tables(spark, empty):
    assert suffix_dedup.remove_repeats(empty).count() == 0
    assert minhash.near_duplicates(empty).count() == 0
    assert mixing.mix(empty).count() == 0
    assert line_rules.clean(empty).count() == 0
    assert pieces.encode_digests(empty, pieces_path()).count() == 0
    assert vectors.near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0
    assert sharding.assign_shards(spark.createDataFrame([], "doc_id long, n_bytes long"), 9).count() == 0
    assert html_text.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_pipeline_runs_and_keeps_columns(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf_dir)
        if name != "sentencepiece":
            assert out.columns == docs.columns
        docs = stored(out, name)
    assert 0 < docs.count()
