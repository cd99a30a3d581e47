"""Fill-in-the-middle against a plain construction, and the round trip."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import pytest

from oreline.llm import fill_middle

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, row string, position string, facts string, form string"


def _sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def _plain(r):
    text = r.text or ""
    units, h = UNIT.findall(text), _sha(f"42:{'null' if r.doc_id is None else r.doc_id}")
    h1, h2, h3, h4 = (int(h[k : k + 8], 16) for k in (0, 8, 16, 24))
    n = len(units)
    if not n or re.search("<[PSM]>", text) or h3 % 100 >= 50:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h4 % 100 < 80:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def _rows():
    rng = random.Random(5)
    stock = ["word", "é", "  two", "\n", "\t", "<", "<P", ">", "日本", "x\x0b", "\x1f", "\xa0"]
    rows = [(k, " ".join(rng.choice(stock) for _ in range(rng.randrange(40)))) for k in range(300)]
    rows += [(k, rng.choice(["a <P> b", "<M>", "", None, " \n ", "one", " one ", "q" * 90_000])) for k in range(300, 380)]
    rows += [(k, "many words " * 20_000) for k in range(380, 386)]
    rows += [rows[7], rows[7], (7, "other text of the id"), (None, "no id here"), (None, "no id here"), (-3, "less than none")]
    return [(*r, "a", "b", "c", "d") for r in rows]


@pytest.mark.parametrize("units, size", [(1024, 16 << 10), (3, 7)])
def test_outputs_and_round_trip(spark, monkeypatch, units, size):
    monkeypatch.setattr(fill_middle, "UNITS_PER_PIECE", units)
    monkeypatch.setattr(fill_middle, "PIECE_BYTES", size)
    rows = _rows() if units > 3 else [r for r in _rows() if len(r[1] or "") < 1000]
    docs = spark.createDataFrame(rows, DOCS).repartition(5)
    parts = fill_middle.pieces(docs)
    got = fill_middle.restore(fill_middle.assemble(parts)).collect()
    want = Counter()
    for r in docs.collect():
        n, form, prefix, middle, output = _plain(r)
        want[r.doc_id, n, form, prefix, middle, _sha(output), _sha(r.text or "")] += 1
    assert Counter(map(tuple, got)) == want
    assert {k[2] for k in want} == {"plain", "psm", "spm"}
    whole = Counter(map(tuple, fill_middle.rearranged(parts).collect()))
    assert whole == Counter((r.doc_id, _plain(r)[1], _plain(r)[4]) for r in docs.collect())


def test_second_sort_moves_nothing(spark):
    docs = spark.createDataFrame(_rows(), DOCS)
    out = fill_middle.restore(fill_middle.assemble(fill_middle.pieces(docs)))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


def test_empty_table(spark):
    parts = fill_middle.pieces(spark.createDataFrame([], DOCS))
    assert fill_middle.restore(fill_middle.assemble(parts)).count() == 0
    assert fill_middle.rearranged(parts).count() == 0
