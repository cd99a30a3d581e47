"""Anchors do not depend on where a long text is cut into segments."""

from __future__ import annotations

import numpy as np

from oreline.llm import suffix_dedup


def test_anchors_are_whole_across_segment_edges(monkeypatch):
    rng = np.random.default_rng(6)
    texts = [rng.integers(0, 256, n).astype(np.uint8) for n in (0, 399, 400, 5000, 20000)]
    whole = [suffix_dedup.anchors(t, 400) for t in texts]
    monkeypatch.setattr(suffix_dedup, "SEGMENT", 700)
    for text, want in zip(texts, whole):
        got = suffix_dedup.anchors(text, 400)
        assert len(set(got["at"].tolist())) == len(got["at"])
        for name in want:
            assert got[name].tolist() == want[name].tolist(), name
