"""Members of a bucket that do not resemble its head are compared with each other."""

from __future__ import annotations

import numpy as np
import pytest

from oreline.llm import minhash


def test_links_beside_a_dissimilar_head(spark):
    passage = [f"t{k}" for k in range(84)]  # 80 shingles of five words
    own = lambda name, n: [f"{name}x{k}" for k in range(n)]
    texts = [passage + own(name, 10) for name in ("x", "y")]  # 80 shared of 100: a link
    texts += [passage + own(f"q{k}", 60) for k in range(1500)]  # 80 of 140: none with any other
    rows = [(k, " ".join(t)) for k, t in enumerate(texts)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(frame).collect()}
    assert got == {0: 0, 1: 0} | {k: k for k in range(2, len(rows))}


@pytest.mark.parametrize("block", [1024, 8])
def test_the_size_of_a_bucket_decides_nothing(spark, monkeypatch, block):
    monkeypatch.setattr(minhash, "BLOCK_SKETCHES", block)
    rng = np.random.default_rng(3)
    bands = rng.integers(-(1 << 62), 1 << 62, (41, 32))
    bands[:, 0] = 5  # all lie in one bucket
    bands[1] = bands[0]
    bands[1, 1:4] += 1 << 40  # like the first one, but not in the bands that follow
    classes = [(bytes([k]), 100, x.tolist()) for k, x in enumerate(bands)]
    classes = spark.createDataFrame(classes, "class binary, n_shingles long, bands array<long>")
    shared = classes.selectExpr("0 as band", "5L as key", "class", "unhex('28') as head", "41L as n")
    hoods = spark.createDataFrame([], "node binary, hood binary")
    got = minhash._stars_across(shared, hoods, classes, 80).distinct().collect()
    assert [(bytes(r.a), bytes(r.b)) for r in got] == [(b"\x00", b"\x01")]
