"""Fill-in-the-middle rearrangement by secondary sort.

A document is cut into units (a word with the white space before it; white space at
the end of a text is a unit too). Two draws from the hash of its id part it into
prefix, middle and suffix; two more choose its form. Nothing is put together in
place: pieces of at most ``UNITS_PER_PIECE`` units are emitted with the document's
row and their position in the output, dealt out by row, and sorted within
partitions by row and position, so that an output streams by in order, piece by
piece, into an incremental digest.

For restoration the sections are told from the marks in the output stream, its
pieces are sorted again, within the partition, by section, and stream into a second
digest. No task holds more than a batch of pieces.

Cases: null and empty texts are plain, of no unit and one empty piece; texts that
contain a mark are plain; a null id draws from the word ``null``; repeated ids and
rows are documents like others, told apart by their row; a unit of any length is cut
into pieces of at most ``PIECE_BYTES``. Rows are numbered by their place in the
input's partitions, so the input should be a scan or another input that is the same
when it is read again. Further columns are ignored. An empty table gives an empty
result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oreline.llm.common import SPACES, require

SEED = 42
# Marks of the sections, percent of rearranged documents, and of those with
# the suffix first.
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
REARRANGED = 50
SUFFIX_FIRST = 80
UNITS_PER_PIECE = 1024
PIECE_BYTES = 16 << 10
BATCH_BYTES = 4 << 20

_SPACE = np.isin(np.arange(256), [ord(c) for c in SPACES])
# Order of the sections in a text.
_SECTIONS = {PREFIX: 0, MIDDLE: 1, SUFFIX: 2}
_FACTS = "doc_id long, n long, form string, prefix_chars long, middle_chars long"
_ARROW_FACTS = pa.struct(
    [
        ("doc_id", pa.int64()),
        ("n", pa.int64()),
        ("form", pa.string()),
        ("prefix_chars", pa.int64()),
        ("middle_chars", pa.int64()),
    ]
)


def unit_ends(data: np.ndarray) -> np.ndarray:
    """Where the units of a text (UTF-8 bytes) end."""
    if not len(data):
        return np.empty(0, np.int64)
    space = _SPACE[data]
    return np.append(np.flatnonzero(~space[:-1] & space[1:]) + 1, len(data))


def draws(doc_id: int | None, seed: int = SEED) -> list[int]:
    """Four numbers from the hash of an id."""
    name = "null" if doc_id is None else str(doc_id)
    digest = hashlib.sha256(f"{seed}:{name}".encode()).hexdigest()
    return [int(digest[k : k + 8], 16) for k in range(0, 32, 8)]


@dataclass
class Cut:
    """How a document is rearranged: its facts, and its output as (bytes, first unit, last unit)."""

    n: int
    form: str
    prefix_chars: int | None
    middle_chars: int | None
    pieces: list[bytes]


def _chars(data: np.ndarray) -> int:
    return int(np.count_nonzero((data & 0xC0) != 0x80))


def cut(doc_id: int | None, data: bytes, seed: int = SEED) -> Cut:
    """The pieces of a document's output, in order; at least one."""
    table = np.frombuffer(data, np.uint8)
    ends = unit_ends(table)
    n = len(ends)
    h1, h2, h3, h4 = draws(doc_id, seed)
    edges = np.append(0, ends)

    def pieces(first: int, last: int) -> list[bytes]:
        stops = [*edges[first:last:UNITS_PER_PIECE].tolist(), int(edges[last])]
        return [
            data[at : min(at + PIECE_BYTES, b)]
            for a, b in zip(stops, stops[1:])
            for at in range(a, b, PIECE_BYTES)
        ]

    if not data or h3 % 100 >= REARRANGED or any(mark in data for mark in _SECTIONS):
        return Cut(n, "plain", None, None, pieces(0, n) or [b""])
    first, last = sorted((h1 % (n + 1), h2 % (n + 1)))
    parts = {PREFIX: (0, first), MIDDLE: (first, last), SUFFIX: (last, n)}
    form = "spm" if h4 % 100 < SUFFIX_FIRST else "psm"
    order = (SUFFIX, PREFIX, MIDDLE) if form == "spm" else (PREFIX, SUFFIX, MIDDLE)
    out = [p for mark in order for p in (mark, *pieces(*parts[mark]))]
    prefix, middle = table[: edges[first]], table[edges[first] : edges[last]]
    return Cut(n, form, _chars(prefix), _chars(middle), out)


def pieces(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", seed: int = SEED) -> DataFrame:
    """``(row, position, facts, body)``: pieces of all outputs; ``facts`` with position 0."""
    require(docs, doc_id, text)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list = []
        positions: list = []
        facts: list = []
        bodies: list = []

        def table() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays(
                [
                    pa.array(rows, pa.int64()),
                    pa.array(positions, pa.int32()),
                    pa.array(facts, _ARROW_FACTS),
                    pa.array(bodies, pa.binary()),
                ],
                names=["row", "position", "facts", "body"],
            )
            for x in (rows, positions, facts, bodies):
                x.clear()
            return out

        size = 0
        for batch in batches:
            for row, key, data in zip(*[batch.column(c).to_pylist() for c in ("row", "doc_id", "body")]):
                found = cut(key, data or b"", seed)
                for k, body in enumerate(found.pieces):
                    rows.append(row)
                    positions.append(k)
                    facts.append(
                        None
                        if k
                        else {
                            "doc_id": key,
                            "n": found.n,
                            "form": found.form,
                            "prefix_chars": found.prefix_chars,
                            "middle_chars": found.middle_chars,
                        }
                    )
                    bodies.append(body)
                    size += len(body) + 64
                    if size > BATCH_BYTES:
                        yield table()
                        size = 0
        if rows:
            yield table()

    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(doc_id).cast("long").alias("doc_id"),
        F.col(text).cast("binary").alias("body"),
    )
    return rows.mapInArrow(emit, f"row long, position int, facts struct<{_typed(_FACTS)}>, body binary")


def _typed(columns: str) -> str:
    return ", ".join(":".join(c.split()) for c in columns.split(","))


def assemble(parts: DataFrame) -> DataFrame:
    """``(row, section, position, facts, output_sha256, body)`` of pieces that stream in order.

    Each document gives one row of section -1 with its facts and the digest of its
    output, and its pieces without the marks, each with the section it belongs to.
    """

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row, facts, digest, section = None, None, None, 0
        for batch in batches:
            done, sections, keep = [], [], []
            new = zip(
                batch.column("row").to_pylist(), batch.column("facts").to_pylist(), batch.column("body").to_pylist()
            )
            for of, head, body in new:
                if of != row:
                    if row is not None:
                        done.append((row, facts, digest.hexdigest()))
                    row, facts, digest, section = of, head, hashlib.sha256(), 0
                digest.update(body)
                mark = facts["form"] != "plain" and body in _SECTIONS
                if mark:
                    section = _SECTIONS[body]
                sections.append(section)
                keep.append(not mark)
            if done:
                yield heads(done)
            few = batch.filter(pa.array(keep, pa.bool_()))
            sections = pa.array([s for s, k in zip(sections, keep) if k], pa.int32())
            none = pa.nulls(len(few), _ARROW_FACTS), pa.nulls(len(few), pa.string())
            yield pa.RecordBatch.from_arrays(
                [few.column("row"), sections, few.column("position"), *none, few.column("body")], names=names
            )
        if row is not None:
            yield heads([(row, facts, digest.hexdigest())])

    def heads(done: list[tuple]) -> pa.RecordBatch:
        of, facts, digests = zip(*done)
        n = len(done)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(of, pa.int64()),
                pa.array([-1] * n, pa.int32()),
                pa.array([0] * n, pa.int32()),
                pa.array(facts, _ARROW_FACTS),
                pa.array(digests, pa.string()),
                pa.nulls(n, pa.binary()),
            ],
            names=names,
        )

    names = ["row", "section", "position", "facts", "output_sha256", "body"]
    ordered = parts.repartition("row").sortWithinPartitions("row", "position")
    return ordered.mapInArrow(
        stream,
        f"row long, section int, position int, facts struct<{_typed(_FACTS)}>, output_sha256 string, body binary",
    )


def restore(assembled: DataFrame) -> DataFrame:
    """One row per document: its facts, ``output_sha256`` and ``restored_sha256``.

    ``assembled`` lies by row already, so the pieces are sorted again where they are.
    """
    names = [c.split()[0] for c in _FACTS.split(", ")]

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        facts, output, digest = None, None, None
        done: list[dict] = []
        for batch in batches:
            for section, head, sha, body in zip(
                *[batch.column(c).to_pylist() for c in ("section", "facts", "output_sha256", "body")]
            ):
                if section < 0:
                    if digest is not None:
                        done.append(facts | {"output_sha256": output, "restored_sha256": digest.hexdigest()})
                    facts, output, digest = head, sha, hashlib.sha256()
                else:
                    digest.update(body)
            if done:
                yield pa.RecordBatch.from_pylist(done, schema)
                done = []
        if digest is not None:
            done.append(facts | {"output_sha256": output, "restored_sha256": digest.hexdigest()})
            yield pa.RecordBatch.from_pylist(done, schema)

    schema = pa.schema([*_ARROW_FACTS, ("output_sha256", pa.string()), ("restored_sha256", pa.string())])
    assert schema.names[: len(names)] == names
    again = assembled.sortWithinPartitions("row", "section", "position")
    return again.mapInArrow(stream, f"{_FACTS}, output_sha256 string, restored_sha256 string")


def rearranged(parts: DataFrame) -> DataFrame:
    """``(doc_id, form, output)``: the outputs as texts, one row per document."""
    each = parts.groupBy("row").agg(
        F.max("facts").alias("facts"),
        F.sort_array(F.collect_list(F.struct("position", "body"))).alias("run"),
    )
    output = F.aggregate("run", F.lit(b""), lambda t, x: F.concat(t, x.body)).cast("string")
    return each.select("facts.doc_id", "facts.form", output.alias("output"))
