"""Line removal against brute force, and the perfect hash alone."""

from __future__ import annotations

import hashlib
import pickle
import random
import re
from collections import Counter

import numpy as np
import pytest

from oreline.llm import line_dedup

DOCS = "doc_id long, text string, mark string, own string, line string, lines string, of string, shard long"


def _key(line):
    line = re.sub(r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "", line)
    return re.sub("[A-Z]", lambda m: m[0].lower(), line)


def _want(rows, least_documents=3):
    holders = {}
    for k, r in enumerate(rows):
        for key in {_key(x) for x in (r.text or "").split("\n")}:
            if len(key) >= 20:
                holders.setdefault(key, []).append(k)
    out = []
    for r in rows:
        lines, left = (r.text or "").split("\n"), []
        for x in lines:
            held = [rows[k].doc_id for k in holders.get(_key(x), [])]
            keeper = max((h for h in held if h is not None), default=None)
            if len(held) < least_documents or r.doc_id == keeper:
                left.append(x)
        sha = hashlib.sha256("\n".join(left).encode()).hexdigest()
        out.append((r.doc_id, None if r.text is None else "\n".join(left), len(lines), len(lines) - len(left), sha))
    return Counter(out)


def _rows():
    rng = random.Random(8)
    stock = [f"a line of its own number {k} and more" for k in range(60)] + ["é" * 20, "é" * 19, "x" * 20, "x" * 19]
    dress = [lambda x: x, str.upper, lambda x: f" \t{x}\x0b\r", lambda x: f"\x1f{x}", lambda x: x + "\xa0"]
    rows = []
    for k in range(120):
        lines = [rng.choice(dress)(rng.choice(stock[: 4 + k])) for _ in range(rng.randrange(9))]
        rows.append((k, "\n".join(lines)))
    rows += [(3, "another text of the id three\n" + stock[0]), rows[5], rows[5], rows[5]]
    rows += [(None, stock[1]), (None, "only rows without an id hold this"), (None, "only rows without an id hold this")]
    rows += [(None, "only rows without an id hold this"), (200, None), (201, ""), (202, "\n\n"), (203, stock[2] + "\n")]
    rows += [(204, f"{stock[3]}\n" * 3000), (2**60 + 1, "x" * 100_000), (2**60 + 2, "x" * 100_000), (2**60 + 3, "x" * 100_000)]
    return [(*r, "a", "b", "c", "d", "e", 9) for r in rows]


@pytest.mark.parametrize("keys, probes", [(1 << 16, 1 << 17), (5, 40)])
def test_lines_go_as_by_brute_force(spark, monkeypatch, keys, probes):
    monkeypatch.setattr(line_dedup, "SHARD_KEYS", keys)
    monkeypatch.setattr(line_dedup, "SLICE_PROBES", probes)
    docs = spark.createDataFrame(_rows(), DOCS)
    out = line_dedup.drop_lines(docs)
    assert out.columns == [*docs.columns, "n_lines", "n_dropped", "kept_sha256"]
    got = out.select("doc_id", "text", "n_lines", "n_dropped", "kept_sha256").collect()
    want = _want(docs.collect())
    assert Counter(map(tuple, got)) == want
    assert any(r[3] for r in want)
    assert {tuple(r) for r in out.select("own", "mark", "shard").collect()} == {("b", "a", 9)}
    assert Counter(map(tuple, line_dedup.drop_lines(docs, least_documents=5).select("doc_id", "text", "n_lines", "n_dropped", "kept_sha256").collect())) == _want(docs.collect(), 5)


def test_perfect_hash_is_minimal_and_exact():
    rng = np.random.default_rng(1)
    for n in (1, 2, 63, 5000):
        hashes = np.unique(rng.integers(-(2**63), 2**63 - 1, (n, 2)), axis=0)
        hashes[: n // 2, 0] = 7  # halves alone do not tell keys apart
        counts, keepers = np.arange(n) + 2, rng.integers(0, 99, n)
        made = line_dedup.LineIndex(hashes, counts, keepers, keepers > 3)
        made = pickle.loads(pickle.dumps(made))
        found = made.find(hashes)
        assert sorted(found.tolist()) == list(range(n))
        assert made.counts[found].tolist() == counts.tolist() and made.keepers[found].tolist() == keepers.tolist()
        assert (made.find(rng.integers(-(2**63), 2**63 - 1, (10_000, 2))) == -1).all()


def test_empty_table(spark):
    docs = spark.createDataFrame([], DOCS)
    assert line_dedup.drop_lines(docs).count() == 0
    assert line_dedup.drop_lines(spark.createDataFrame([(1, "short")], "doc_id long, text string")).first().n_dropped == 0
