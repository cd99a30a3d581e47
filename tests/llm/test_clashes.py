"""Working names as columns of the input, repeated and null ids, planted links in large shards."""

from __future__ import annotations

import random
import re
from collections import Counter
from pathlib import Path

import numpy as np
import pytest

import corpus_pipeline
from oreline.llm import (
    fill_middle,
    html_text,
    line_dedup,
    line_rules,
    manifest,
    minhash,
    mixing,
    pieces,
    quality_classifier,
    sharding,
    suffix_dedup,
    vectors,
)
from oreline.llm.queries import pieces_path

BASE = ["doc_id", "text", "lang", "source", "n_chars"]


def names_in(module) -> list[str]:
    """Every name that stands in quotes in a module, and could be one of its columns."""
    source = Path(module.__file__).read_text()
    words = set(re.findall(r'"([a-z][a-z0-9_]*)"', source)) | set(re.findall(r"\bas ([a-z_]+)", source))
    return sorted(words - set(BASE) - {"url", "html", "page_id", "vec_id", "embedding", "n_bytes"})


def clashing(frame, module):
    for name in names_in(module):
        frame = frame.withColumn(name, frame[frame.columns[0]])
    return frame


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(5)
    words = lambda n: " ".join(f"w{rng.randrange(300)}" for _ in range(n))
    texts = [words(80) for _ in range(8)] + [None, "", "short"]
    texts += [texts[0], texts[0] + " x", f"{words(9)} {texts[1]}"]
    rows = [(k, t, "en", f"s{k % 3}", 1) for k, t in enumerate(texts)]
    rows += [rows[2], rows[2], (3, "another text of this id " + words(60), None, None, None), (None, texts[4], None, "s1", None)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


RUNS = {
    "sharding": (sharding, lambda f: sharding.assign_shards(f.withColumn("n_bytes", f.n_chars), 3)),
    "line_rules": (line_rules, line_rules.clean),
    "mixing": (mixing, lambda f: mixing.copies(f, mixing.mix(f))),
    "pieces": (pieces, lambda f: pieces.encode_digests(f, pieces_path())),
    "suffix_dedup": (suffix_dedup, lambda f: suffix_dedup.remove_repeats(f, length=120)),
    "minhash": (minhash, minhash.one_of_each),
    "manifest": (manifest, manifest.proofs_of),
    "line_dedup": (line_dedup, line_dedup.drop_lines),
    "fill_middle": (fill_middle, lambda f: fill_middle.restore(fill_middle.assemble(fill_middle.pieces(f)))),
    "near_duplicates": (minhash, minhash.near_duplicates),
}


@pytest.mark.parametrize("name", sorted(RUNS))
def test_columns_with_working_names_change_nothing(docs, name):
    module, run = RUNS[name]
    plain, more = run(docs), run(clashing(docs, module))
    assert plain.count()
    columns = [c for c in plain.columns if c in more.columns and c not in names_in(module)]
    key = lambda r: str(tuple(r))
    assert columns
    assert sorted(plain.select(*columns).collect(), key=key) == sorted(more.select(*columns).collect(), key=key)


def test_classifier_with_working_names(spark, docs):
    labels = docs.select("doc_id").distinct().selectExpr("doc_id", "doc_id % 2 as quality")
    scores = []
    for frame in (docs, clashing(docs, quality_classifier).withColumn("quality", docs.n_chars)):
        train = quality_classifier.training_rows(frame, clashing(labels, quality_classifier))
        out = quality_classifier.score(frame, quality_classifier.fit(train), name="rated")
        scores.append(sorted(map(str, out.select("doc_id", "rated").collect())))
    assert scores[0] == scores[1] and len(scores[0]) == docs.count()


def test_pipeline_stages_keep_columns_whatever_their_names(spark, docs, monkeypatch, tmp_path):
    labels = docs.select("doc_id").where("doc_id is not null").distinct().selectExpr("doc_id", "1 as quality", "0 as toxic")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    for frame in (docs, docs.where("false")):
        for module in (minhash, mixing, suffix_dedup, quality_classifier):
            frame = clashing(frame, module)
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, frame, str(tmp_path))
            if name != "sentencepiece":
                assert out.columns == frame.columns, name
            out.count()


def test_ids_that_repeat_or_are_null_lose_no_link(spark):
    rng = random.Random(1)
    words = [f"w{k}" for k in range(90)]
    near = [*words[:40], "changed", *words[41:]]
    other = [f"v{rng.randrange(999)}" for _ in range(70)]
    rows = [(1, words), (1, other), (2, near), (None, other), (None, other + ["x"]), (5, other + ["y"]), (None, ["alone"] * 9)]
    frame = spark.createDataFrame([(k, " ".join(t)) for k, t in rows], "doc_id long, text string")
    found = minhash.near_duplicates(frame)
    got = Counter((r.doc_id, r.component_id, r.kept) for r in found.collect())
    assert got == Counter({(1, 1, True): 2, (2, 1, False): 1, (None, 1, False): 2, (5, 1, False): 1, (None, None, False): 1})
    left = [r.text for r in minhash.one_of_each(frame).collect()]
    assert sorted(left) == sorted([" ".join(words), " ".join(other), " ".join(["alone"] * 9)])


def test_a_passage_that_many_texts_quote(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK_SKETCHES", 64)
    passage = [f"t{k}" for k in range(84)]
    own = lambda name, n: [f"{name}x{k}" for k in range(n)]
    texts = [passage + own(f"{p}{k}", 10) for p in "ab" for k in range(2)] + [passage + own(f"q{k}", 60) for k in range(900)]
    texts += [passage + own("pair", 55) + own(f"e{k}", 5) for k in range(2)]
    rows = [(k, " ".join(t)) for k, t in enumerate(texts)]
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    want = {k: k for k in range(len(rows))} | {k: 0 for k in range(4)} | {904: 904, 905: 904}
    assert got == want


def test_vectors_of_one_id_and_planted_links_in_large_shards(spark, monkeypatch):
    monkeypatch.setattr(vectors, "LEAST_SHARDS", 2)
    searched = []
    search = vectors.Graph.search
    monkeypatch.setattr(vectors.Graph, "search", lambda self, *a: searched.append(1) or search(self, *a))
    rng = np.random.default_rng(4)
    base = rng.normal(size=(4400, 24))
    near = base[:300] + rng.normal(size=(300, 24)) * 0.12
    v = np.concatenate([base, near])
    unit = v / np.linalg.norm(v, axis=1, keepdims=True)
    linked = unit @ unit.T >= 0.95
    ids = np.arange(len(v))
    ids[4000] = 17  # another vector of a used id
    rows = [(int(i), [float(x) for x in row]) for i, row in zip(ids, v)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = Counter((r.vec_id, r.n_links) for r in vectors.near_vectors(frame).collect())
    want = Counter((int(i), int(n) - 1) for i, n in zip(ids, linked.sum(axis=1)))
    assert sum(n for _, n in want) > 300
    agree = sum((got & want).values())
    assert agree >= 0.99 * len(v)
    graph = vectors.Graph(unit[:2500].astype(np.float32))
    some = unit[2500:2600]
    r, c = vectors.links_of(graph, unit[:2500], some, 0.95, np.full(100, -1))
    assert searched and set(zip(r, c)) == set(zip(*np.nonzero(some @ unit[:2500].T >= 0.95)))


def test_mix_is_that_of_its_schedule(spark):
    """Taken words recomputed slot by slot, document by document."""
    rng = random.Random(6)
    rows = [(k, " ".join(["w"] * rng.randrange(90)), [None, "a", "b", "c", "d"][min(4, rng.randrange(9))]) for k in range(700)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r.doc_id: r for r in mixing.mix(frame).collect()}
    shares = mixing.targets(mixing.sized(frame))
    slots = {}
    for r in mixing.schedule(shares).collect():
        slots.setdefault(r.number, []).append((r.slot, r["rank"]))
    names = {r.source: (r.number, r.source_size, r.target) for r in shares.collect()}
    total, line = sum(s for _, s, _ in names.values()), sum(t for _, _, t in names.values())
    assert abs(line - total) < 1e-6 * total
    ends = np.cumsum([names[s][2] for s in sorted(names, key=lambda s: (s is None, s))])
    for t, number in sorted((t, n) for n, of in slots.items() for t, _ in of):
        point = (t * mixing.GOLDEN) % 2**31 / 2**31 * line
        assert number == int(np.searchsorted(ends, point, side="right")) or min(abs(ends - point)) < 1e-3
    for source, (number, size, _) in names.items():
        ranks = [k for _, k in sorted(slots.get(number, []))]
        assert ranks == list(range(len(ranks)))
        n_blocks = -(-size // 32)
        uses = Counter(k % n_blocks for k in ranks if k < 3 * n_blocks)
        at = 0
        for r in sorted((r for r in got.values() if r.source == source), key=lambda r: (r.mix_order, r.size)):
            taken = sum(uses[w // 32] for w in range(at, at + r.size))
            assert taken == r.taken
            at += r.size
