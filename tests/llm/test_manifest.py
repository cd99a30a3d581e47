"""The Merkle tree and its proofs against a plain construction."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from oreline.llm import manifest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, leaf string, tree string, at int"


def _sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def _leaf(row, text):
    fields = [row.doc_id, row.source, row.lang, row.n_chars, text]
    return _sha("".join("-" if f is None else f"{len(str(f).encode())}:{f}" for f in fields))


def _path(nodes, place):
    """Siblings on the way up, and the root."""
    sides = []
    while len(nodes) > 1:
        first = place // 16 * 16
        run = nodes[first : first + 16]
        sides.append(("".join(run[: place - first]), "".join(run[place - first + 1 :])))
        nodes, place = ["".join(nodes[k : k + 16]) for k in range(0, len(nodes), 16)], place // 16
        nodes = [_sha(n) for n in nodes]
    return sides, nodes[0]


def _want(rows, tampered):
    by = {}
    for r in rows:
        by.setdefault(r.source, []).append(r)
    order = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    leaves = {}
    for s in order:
        by[s].sort(key=lambda r: (r.doc_id is not None, r.doc_id or 0, _leaf(r, r.text)))
        leaves[s] = [_leaf(r, r.text) for r in by[s]]
    subroots = [_path(leaves[s], 0)[1] for s in order]
    out = []
    for k, s in enumerate(order):
        for place, r in enumerate(by[s]):
            low, sub = _path(leaves[s], place)
            high, root = _path(subroots, k)
            folded = _leaf(r, r.text.lower()) if tampered(r) else leaves[s][place]
            for left, right in low + high:
                folded = _sha(left + folded + right)
            proof = _sha("".join(a + b for a, b in low + high))
            out.append((r.doc_id, leaves[s][place], sub, root, proof, folded, folded == root))
    return sorted(out, key=str)


@pytest.mark.parametrize("block", [4096, 48, 7])
def test_proofs_are_those_of_a_plain_tree(spark, monkeypatch, block):
    monkeypatch.setattr(manifest, "BLOCK_LEAVES", block)
    rng = random.Random(3)
    sizes = {None: 3, "a": 1, "b": 16, "c": 17, "é": 300, "d": 40} | {f"s{k}": 2 for k in range(30)}
    rows = [
        (10 * k, rng.choice(["Some Text", "small", "", None, "É\n"]), "en", s, k % 5 or None, "x", "y", 1)
        for s, n in sizes.items()
        for k in range(n)
    ]
    rows += [rows[40], rows[40], (None, "No Id", None, "b", None, "x", "y", 1), (2**53 + 1, "T", None, "b", 1, "", "", 0)]
    frame = spark.createDataFrame(rows, DOCS)
    out = manifest.proofs_of(frame, F.col("doc_id") % 3 == 0, text=F.lower("text"))
    want = _want(frame.collect(), lambda r: r.doc_id is not None and r.doc_id % 3 == 0 and r.text is not None)
    got = [tuple(r) for r in out.collect()]
    assert sorted(got, key=str) == want
    assert {r[-1] for r in want} == {True, False}


def test_proofs_of_some_leaves_fold_to_the_root(spark):
    rows = [(k, f"text {k}", "en", f"s{k % 3}", k, "", "", 0) for k in range(900)]
    made = manifest.build(manifest.leaves(spark.createDataFrame(rows, DOCS)))
    some = manifest.prove(made, made.leaves.where("doc_id % 97 = 0"), whole=True).collect()
    assert {r.doc_id for r in some} == set(range(0, 900, 97))
    for r in some:
        assert manifest.fold(r.leaf, [(p.left, p.right) for p in r.proof]) == r.root
        assert r.folded_root == r.root and r.verified
        assert manifest.fold(_sha("other"), [(p.left, p.right) for p in r.proof]) != r.root


def test_missing_nodes_are_the_fewest():
    found = dict(manifest._missing(np.arange(4096, 8192), 5 * 4096))
    assert {k: v.tolist() for k, v in found.items()} == {0: [], 1: [], 2: [], 3: [0, 2, 3, 4]}
    found = dict(manifest._missing(np.array([0, 1, 17]), 40))
    assert {k: len(v) for k, v in found.items()} == {0: 29, 1: 1}


@pytest.mark.parametrize("n", [0, 1])
def test_smallest_tables(spark, n):
    rows = spark.createDataFrame([(5, "T", "en", "a", 1, "", "", 0)][:n], DOCS)
    got = manifest.proofs_of(rows).collect()
    assert len(got) == n
    for r in got:
        assert r.leaf == r.subroot == r.root == r.folded_root and r.proof_sha256 == _sha("")
